"""Documents with the awkward cases that every operator must survive."""

import random

#: Where the smallest given tables are.
DIR = "/root/testdata/sf0.001"

DOCS = "doc_id long, text string, lang string, source string, n_chars long, row string, score string, id string, n string, spans string"


def sentence(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6))) for _ in range(n))


def texts(seed: int = 1) -> list[str | None]:
    rng = random.Random(seed)
    base = [sentence(rng, rng.randint(20, 80)) for _ in range(20)]
    near = [t.replace(" ", " ", 1).rsplit(" ", 1)[0] + " changed" for t in base[:6]]
    return [None, "", " \n\t ", "one", "one two three four", "A b C d e F", "a B c D e f", "Zürich – größer", sentence(rng, 20_000), *base, *base[:5], base[0], *near]


def documents(spark, rows=None):
    """The texts as documents with repeated rows, null languages and columns of clashing names."""
    rows = texts() if rows is None else rows
    data = [(k, t, ("en", "de", None)[k % 3], f"s{k % 4}" if k % 5 else None, len(t or ""), "x", "y", "z", "w", "v") for k, t in enumerate(rows)]
    if data:
        data.append(data[-1])
    return spark.createDataFrame(data, DOCS)
