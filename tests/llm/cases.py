"""Small inputs that every operator must take: nulls, empty and long texts, ties, repeats, clashing names."""

from __future__ import annotations

import random

# Columns with names that operators use inside; they must not get in the way.
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, _id long, _norm string, _row string, "
          "kept string, anchor long, window string, block string, position long, q string")


def words(seed: int, n: int, size: int = 400) -> list[str]:
    rng = random.Random(seed)
    return [f"w{rng.randrange(size)}" for _ in range(n)]


def odd_texts() -> list[str | None]:
    base = words(1, 120)
    edited = base[:60] + ["changed"] + base[61:]
    return [
        None, "", "   \t\n ", "one", "one two three", " ".join(base), " ".join(base), "  ".join(base) + "\n",
        "\n".join([" ".join(base[:40]), " ".join(base[40:])]), " ".join(edited), " ".join(base[30:110]),
        " ".join(words(2, 60) + base[20:90] + words(3, 60)), " ".join(words(4, 4000)), "é " * 30 + "ß ß x",
        "Buy now! " * 200, "a | b | c | d | e | f\nHome About Contact\nAll rights reserved.\n" + " ".join(words(5, 30)),
        "0 1 2 3 \x1c4 \x855 <|endoftext|> x　y", "x" * 30_000, "\n".join(["same line of words here"] * 30),
    ]


def odd_documents(spark):
    rows = []
    for i, t in enumerate(odd_texts()):
        rows.append((100 - i, t, ["en", "fr", None][i % 3], ["a", "a", None, ""][i % 4], 5, 1, "n", "r", "k", 2, "w", "b", 3, "q"))
    rows.append(rows[5])                                       # a repeated row
    rows.append((None, *rows[6][1:]))                          # null identifiers
    rows.append((None, None, *rows[6][2:]))
    return spark.createDataFrame(rows, SCHEMA)


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)
