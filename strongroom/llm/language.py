"""Language ID: hyperdimensional n-gram profiles.

Every letter has a random vector of +1 and -1.  An n-gram binds the vectors of
its letters, each rotated by its place (element-wise product); a text bundles
the vectors of all its n-grams (sum); a language prototype bundles the
unit-length texts of its labelled rows.  A text's language is the prototype
of largest cosine.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: Letters with a vector of their own; all others share vectors by code point.
OWN, LETTERS, N = 0x250, 1024, 3


def letter_vectors(dim: int, seed: int):
    """The vectors by letter number; 0 is the border of a word."""
    import numpy as np

    return (np.random.default_rng(seed).integers(0, 2, (LETTERS, dim)) * 2 - 1).astype(np.int8)


def gram_vectors(grams, vectors):
    """One vector for each n-gram number: rotated letters, multiplied."""
    import numpy as np

    out = np.ones((len(grams), vectors.shape[1]), dtype=np.int8)
    for place in range(N):
        out *= np.roll(vectors, place, axis=1)[(grams // LETTERS**place) % LETTERS]
    return out.astype(np.float32)


def letter_numbers():
    """A function: code points to letter numbers, by a table of this worker."""
    import numpy as np

    table = np.full(0x110000, -1, dtype=np.int16)
    number = lambda c: 0 if not chr(c).isalpha() else c if c < OWN else OWN + c % (LETTERS - OWN)

    def numbers(points):
        out = table[points]
        if (out < 0).any():
            for c in np.unique(points[out < 0]).tolist():
                table[c] = number(c)
            out = table[points]
        return out

    return numbers


def bundles(texts: list[str | None], numbers, vectors, chunk: int = 1 << 20):
    """Vectors of the texts; a zero row for one without letters."""
    import numpy as np

    out = np.zeros((len(texts), vectors.shape[1]), dtype=np.float32)
    keys, k = [], 0

    def add():
        if keys:
            found, counts = np.unique(np.concatenate(keys), return_counts=True)
            doc, gram = found // LETTERS**N, found % LETTERS**N
            grams, at = np.unique(gram, return_inverse=True)
            docs, row = np.unique(doc, return_inverse=True)
            for part in range(0, len(grams), 4096):
                here = (at >= part) & (at < part + 4096)
                matrix = np.zeros((len(docs), min(4096, len(grams) - part)), dtype=np.float32)
                matrix[row[here], at[here] - part] = counts[here]
                out[docs] += matrix @ gram_vectors(grams[part : part + 4096], vectors)
            keys.clear()

    held = 0
    for k, text in enumerate(texts):
        points = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), dtype="<u4")
        for start in range(0, len(points), chunk):  # chunks share their last letters, so no n-gram is lost
            x = numbers(points[max(0, start - N + 1) : start + chunk]).astype(np.int64)
            x = x if start else np.concatenate([[0], x])
            x = np.concatenate([x, [0]]) if start + chunk >= len(points) else x
            if len(x) < N:
                continue
            grams = x[: len(x) - 2] + x[1:-1] * LETTERS + x[2:] * LETTERS**2
            grams = grams[(x[1:-1] > 0)]  # the middle is a letter
            if len(grams):
                keys.append(grams + k * LETTERS**N)
                held += len(grams)
        if held >= chunk:
            add()
            held = 0
    add()
    return out


def batched(batches: Iterator, rows: int = 64):
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            yield batch.slice(k, rows)


def learn(df: DataFrame, text_col: str, lang_col: str, dim: int = 1024, seed: int = 7):
    """Language names and their unit prototypes, learned from rows with text and language.

    All rows count, so a language of few rows is known too; their bundles are
    added up on the executors, and one vector for each language comes to the
    driver.
    """
    import numpy as np

    rows = df.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))

    def run(batches):
        import pyarrow as pa

        numbers, vectors, sums = letter_numbers(), letter_vectors(dim, seed), {}
        for batch in batched(batches):
            out = bundles(batch.column(1).to_pylist(), numbers, vectors)
            out /= np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)
            langs = np.array(batch.column(0).to_pylist(), dtype=object)
            for lang in set(langs):
                sums[lang] = sums.get(lang, 0) + out[langs == lang].sum(axis=0, dtype=np.float64)
        for lang, total in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * dim), pa.array(range(dim), pa.int32()), pa.array(total)], names=["lang", "i", "v"])

    parts = rows.mapInArrow(run, "lang string, i int, v double").groupBy("lang", "i").agg(F.sum("v").alias("v"))
    found = parts.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("i", "v"))).getField("v").alias("v")).collect()
    found = sorted((r for r in found if any(r.v)), key=lambda r: r.lang)
    prototypes = np.array([r.v for r in found]).reshape(len(found), dim)
    return [r.lang for r in found], prototypes / np.linalg.norm(prototypes, axis=1, keepdims=True)


def identify(df: DataFrame, model, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), dim: int = 1024, seed: int = 7) -> DataFrame:
    """``keep`` columns, ``lang_pred`` and ``score`` (the cosine, 0 to 1) for each row.

    Whole texts.  Null texts and texts without a letter, and all texts if the
    model knows no language, give ``und`` and 0; ties go to the first language
    by name.  Repeated rows give repeated results, an empty table none.
    """
    langs, prototypes = model
    schema = T.StructType([T.StructField(c, df.schema[c].dataType) for c in keep] + [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches):
        import numpy as np
        import pyarrow as pa

        numbers, vectors = letter_numbers(), letter_vectors(dim, seed)
        for batch in batched(batches):
            out = bundles(batch.column(len(keep)).to_pylist(), numbers, vectors).astype(np.float64)
            norms = np.linalg.norm(out, axis=1)
            if langs:
                cosines = (out @ prototypes.T) / np.maximum(norms, 1e-9)[:, None]
                best = cosines.argmax(axis=1)
                score = np.clip(cosines[np.arange(len(best)), best], 0, 1)
            known = (norms > 0) & bool(langs)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array([langs[best[k]] if known[k] else "und" for k in range(len(known))], pa.string()),
                 pa.array([float(score[k]) if known[k] else 0.0 for k in range(len(known))], pa.float64())], names=schema.names)

    return df.select(*[F.col(c) for c in keep], F.col(text_col).alias("_text")).mapInArrow(run, schema)
