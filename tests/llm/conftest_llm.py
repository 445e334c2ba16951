"""Rows that the tests of this folder share."""

import zlib


def fold(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5


#: Null and empty texts, ties, repeated rows, one long text, null ids and sources, and columns
#: whose names the operators use themselves.
ODD = [
    (1, "the quick brown fox jumps over the lazy dog", "en", "a", 9),
    (2, "the quick  brown fox\tjumps over the lazy dog", "en", "a", 9),
    (2, "the quick  brown fox\tjumps over the lazy dog", "en", "a", 9),
    (3, None, None, None, None),
    (4, "", "en", "b", 0),
    (5, " \n\t ", "fr", "b", 4),
    (None, "le chat noir dort sur la table rouge", "fr", "b", 5),
    (None, None, None, None, None),
    (7, "12345 --- 67890", "fr", None, 15),
    (8, "le chien blanc mange dans la maison verte " * 3000, "fr", "b", 1),
    (9, "écrire à jean@exemple.fr ou +33 1 23 45 67 89 01, carte 4111 1111 1111 1111", "fr", "c", 2),
]
ODD_SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long")
