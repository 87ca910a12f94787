"""Rows of the edge-case tables."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# columns that operators use inside or return: all must survive in a document table that has them too
CLASHING = ("fp", "component", "component_id", "key", "line", "score", "predicted", "shard", "slot", "tokens", "weight",
            "sampled", "k1", "size", "bin", "text_key", "id", "id_set", "copy", "n_lines", "dropped", "topic", "t",
            "words", "rid", "name", "node", "u", "v")
LONG = " ".join(f"word{i % 977}x{i % 31}" for i in range(30_000))
EDGE = [
    (1, "The same text twice, row and all, to be told apart by nothing else here.", "en", "a", 10),
    (1, "The same text twice, row and all, to be told apart by nothing else here.", "en", "a", 10),
    (1, "One id with another text altogether, quite unlike the first of its name.", "en", "a", 10),
    (2, None, "en", None, None),
    (3, "", None, "b", 0),
    (4, " \t\n \r ", "de", "b", 4),
    (None, "A text without an id that nobody else repeats, ever, in this table.", "en", "b", 5),
    (None, None, None, None, None),
    (6, LONG, "en", "a", len(LONG)),
    (7, LONG, "en", "a", len(LONG)),
    (8, "tie\ntie\ntie\nties are broken by the smallest id of all the documents here", "fr", "c", 3),
    (9, "ties are broken by the smallest id of all the documents here\ntie", "fr", "c", 3),
    (10, "x", "es", "c", 1),
]
