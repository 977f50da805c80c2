"""Small document tables."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
SCHEMA = "doc_id long, text string, source string, row string, bands long, a long, n int"


def words(text):
    return WORD.findall(text or "")


def documents(spark, rows, partitions=3):
    """``(doc_id, text)`` or ``(doc_id, text, source)`` with extra columns whose
    names operators use inside."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "s", "x", 7, 8, 9) for r in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(partitions)


def corpus(seed=3, size=60):
    """Random texts in which passages, near copies and copies repeat."""
    rng = random.Random(seed)
    lexicon = ["".join(rng.choice("abcdeéñ日") for _ in range(rng.randint(1, 6))) for _ in range(120)]
    prose = lambda n: [rng.choice(lexicon) for _ in range(n)]
    passages = [prose(rng.randint(22, 60)) for _ in range(4)]
    texts = []
    for i in range(size):
        kind = rng.random()
        if kind < 0.25 and texts:
            texts.append(rng.choice(texts))
        elif kind < 0.5 and texts:
            near = words(rng.choice(texts)) or ["x"]
            near[rng.randrange(len(near))] = "edited"
            texts.append(" ".join(near))
        else:
            body = prose(rng.randint(0, 150))
            if rng.random() < 0.6:
                body[len(body) // 2 : len(body) // 2] = rng.choice(passages)
            texts.append(rng.choice([" ", "\n", "\t "]).join(body))
    rows = [(i, t, f"s{i % 4}") for i, t in enumerate(texts)]
    rows += [(size, None), (size + 1, ""), (size + 2, " \n "), (size + 3, "word"), (size + 4, "the same " * 400), (size + 5, "q" * 3000), (size + 6, "q" * 3000)]
    return rows


def table(df, key="doc_id"):
    return {r[key]: r.asDict() for r in df.collect()}
