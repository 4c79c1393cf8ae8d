"""Small document tables with the awkward cases, and brute-force counterparts."""

import re

AWKWARD = [
    (1, "The quick brown fox jumps over the lazy dog near the old river bank today."),
    (2, "The quick brown fox jumps over the lazy dog near the old river bank today."),
    (3, ""),
    (4, None),
    (None, "A text without an id, yet with words in it."),
    (None, None),
    (5, "   \n\t "),
    (6, "12345 67890 !!! ???"),
    (7, "é" * 40 + " ü ß 日本語 😀😀"),
    (8, "a" * 3000),
    (9, "word " * 30000),
    (9, "another text under the same id as a very long one"),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n long, id long, mark int, place long, h long"


def documents(spark, rows=AWKWARD):
    """Documents with extra columns whose names operators use themselves."""
    return spark.createDataFrame([(i, t, None, "s", None, 7, 8, 9, 10, 11) for i, t in rows], SCHEMA)


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def word_list(text):
    lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x20\x09-\x0D]+", lowered)


def shingles(text, words):
    found = word_list(text)
    if len(found) >= words:
        return {tuple(found[i : i + words]) for i in range(len(found) - words + 1)}
    return {tuple(found)} if found else set()


def classes(rows, words, p, q):
    """Smallest id reachable by links, per row (brute force over all pairs)."""
    sets = [shingles(t, words) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if rows[i][0] is None or rows[j][0] is None or not sets[i] or not sets[j]:
                continue
            both = len(sets[i] & sets[j])
            if both * q >= p * (len(sets[i]) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        if rows[i][0] is not None:
            groups.setdefault(find(i), []).append(rows[i][0])
    return [min(groups[find(i)]) if rows[i][0] is not None else None for i in range(len(rows))], [len(s) for s in sets]
