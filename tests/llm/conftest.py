from __future__ import annotations

import random

import pytest

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          # names that the operators use inside
          "rid long, t1 string, t2 long, row int, key string, n int, pos int, size string, shard string, slot int, words string")


def documents(spark, rows, parts=3):
    """(doc_id, text[, source]) with all other columns filled, in several partitions."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", 1, 7, "t", 7, 7, "k", 7, 7, "x", "y", 7, "w") for r in rows]
    df = spark.createDataFrame(full, SCHEMA)
    return df.repartition(parts) if rows else df


@pytest.fixture(scope="session")
def awkward():
    """Nulls, empty and blank texts, repeated rows and ids, copies, near copies, other scripts, very long texts."""
    rnd = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)] + ["Straße", "naïve", "ΣΑΣ", "中文字", "🙂x", "don't", "a-b"]
    base = [rnd.choice(vocabulary) for _ in range(80)]
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "One"), (6, "two words"), (None, " ".join(base)), (None, None)]
    for i in range(10, 40):
        near = list(base)
        for _ in range(i % 5):
            near[rnd.randrange(len(near))] = rnd.choice(vocabulary)
        rows.append((i, " ".join(near)))
    rows += [(i, "\n".join(" ".join(rnd.choice(vocabulary) for _ in range(rnd.randrange(1, 12))) for _ in range(6))
              ) for i in range(40, 60)]
    rows += [(60, "de " * 500), (61, "x" * 300_000), (62, " ".join(rnd.choice(vocabulary) for _ in range(30_000))),
             (63, "\n" * 2000), (64, "A line that is held twice\n  a LINE that is held twice \nshort\nshort")]
    rows += [(70 + i, "the same text of every copy, which is long enough to have words and shingles " * 2) for i in range(30)]
    rows += [rows[12], rows[12], (10, "another text under an id that is taken already, with more words in it")]
    return rows
