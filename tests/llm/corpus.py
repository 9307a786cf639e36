"""Small corpora with the awkward cases, and plain-Python versions of the operators."""

from __future__ import annotations

import random
import re

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def corpus(seed: int = 1, n: int = 60) -> list[tuple]:
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)] + ["Émile", "ÉMILE", "Straße", "THE", "the"]
    prose = lambda k: " ".join(rng.choice(words) for _ in range(k))
    base, passage, line = prose(90), prose(70), "A line that many documents share, word for word."
    rows = []
    for i in range(n):
        kind = i % 10
        if kind == 0:
            text = base
        elif kind == 1:
            edited = base.split()
            edited[rng.randrange(len(edited))] = "changed"
            text = " ".join(edited)
        elif kind == 2:
            text = prose(30) + "\n" + passage + "\n" + prose(20)
        elif kind == 3:
            text = f"{line}\n{prose(8)}\n  {line.upper()} \n{prose(5)}\n{line}"
        elif kind == 4:
            text = prose(rng.randrange(1, 7))
        elif kind == 5:
            text = base.replace(" ", "\t \n", 3)
        else:
            text = prose(rng.randrange(5, 160))
        rows.append((i * 7 % n, text, "en", f"s{i % 3}" if i % 4 else "hot", len(text)))
    rows += [(n, None, None, None, None), (n + 1, "", "xx", "", 0), (n + 2, " \t\n", "en", "hot", 3), (n + 3, prose(6000), "en", "hot", 0), (n + 4, "one", "en", "hot", 3)]
    rows += [(n + 5, prose(12), "en", "hot", 1), (n + 5, prose(14), "en", "hot", 1)]  # an id twice
    rows += [rows[3], (None, base, "en", "hot", 0)]  # a row twice, and a row without an id
    return rows


def frame(spark, rows, extra: bool = True):
    """The rows, with columns whose names could clash."""
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    if extra:
        from pyspark.sql import functions as F

        df = df.withColumns({c: F.lit(1) for c in ("n", "size", "kept", "h", "bits", "word", "shard_", "node", "component", "sig", "start", "fp", "owner", "a", "b", "k")})
    return df


def words(text, lower: bool = False) -> list[bytes]:
    b = (text or "").encode()
    return re.findall(rb"[^\x20\x09-\x0D]+", b.lower() if lower else b)


def components(nodes, links):
    up = {x: x for x in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {x: find(x) for x in nodes}
