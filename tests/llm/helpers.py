"""Plain Python versions of the operators' building blocks, and awkward fixtures."""

import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long, line string, size int, c0 string"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles(text):
    w = words(lower(text))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])


def documents(spark, rows):
    """rows: (doc_id, text[, source]); other columns have names that operators use inside."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1]), "x", 1, "y") for r in rows]
    return spark.createDataFrame(full, DOCS)


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def awkward(rng):
    """Null, empty, blank and long texts, odd white space, copies, a repeated row, a null id."""
    base = prose(rng, 120)
    lines = "\n".join(prose(rng, 6) for _ in range(12))
    rows = [(5, base), (2, base), (9, base.upper()), (9, base.upper()), (7, None), (8, ""), (11, " \t\n\x0b\x0c\r "),
            (12, "one two"), (13, "ONE two"), (14, "\u00e9t\u00e9 \u00a0nbsp \u2003em  x\ty\n"), (None, base + " tail of it"),
            (15, prose(rng, 30_000)), (16, lines), (17, "\n  " + lines.replace("\n", " \n").upper() + "\n\n"), (18, lines + "\nshort"),
            (-3, base[:300] + " " + prose(rng, 60)), (19, "a " * 500), (20, "a " * 499 + "\x00b")]
    for i in range(12):
        w = words(base)
        w[(7 * i) % len(w)] = f"edit{i}"
        rows.append((100 + i, " ".join(w)))
    return rows + [(200 + i, prose(rng, rng.randrange(1, 60))) for i in range(25)]
