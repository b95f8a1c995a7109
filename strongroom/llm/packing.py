"""Packing: cost-balanced packing of tokenised documents into sequences.

A document's cost is estimated as linear (feed-forward) plus quadratic
(attention) in its length.  Documents, longest first, go to the sequence of
lowest cost so far that still has room for them.

Each task packs the documents it reads, in groups of about ``group_tokens``
tokens, so no text and no token is shuffled and memory is bounded by one
group.  Chunks of ``max_tokens`` of a long document are sequences of their
own at once.  The capacities of a group's sequences add up to its tokens
exactly: full ones, and the rest as powers of two (which need no padding).  A
document that fits nowhere whole is cut at what the cheapest open sequence
has left, so every sequence ends up full.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def cost(length: int, linear: float, quadratic: float) -> float:
    return linear * length + quadratic * length * length


def capacities(total: int, max_tokens: int) -> list[int]:
    """Full sequences and, for the rest, one for each binary digit."""
    rest = total % max_tokens
    return [max_tokens] * (total // max_tokens) + [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]


def assign(lengths: list[int], max_tokens: int, linear: float, quadratic: float) -> Iterator[tuple[int, int, int, int, int]]:
    """(piece, start in the piece, length, sequence, offset) for all pieces."""
    import numpy as np

    caps = capacities(sum(lengths), max_tokens)
    free = np.array(caps, dtype=np.int64)
    spent = np.zeros(len(caps))
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        at, left = 0, lengths[i]
        while left:
            room = free >= left
            whole = bool(room.any())
            k = int(np.where(room if whole else free > 0, spent, np.inf).argmin())
            n = left if whole else int(free[k])
            yield i, at, n, k, caps[k] - int(free[k])
            free[k] -= n
            spent[k] += cost(n, linear, quadratic)
            at, left = at + n, left - n


def token_bytes(tokenizer, eos_id: int, tables: dict | None = None, most: int = 800_000):
    """A function: a text to its ids as little-endian unsigned 32-bit bytes.

    The tokenizer's own steps are: lower case, parts by its pattern (never
    across white space), then merges inside each part.  Words between spaces
    and line feeds, and the parts of words of Latin-1 characters, are looked
    up after the first time; ``tables`` keeps them between tasks of a worker
    and is emptied when it holds ``most`` of either.  Any other word, and one
    that may hold a special token, goes through the tokenizer whole.
    """
    from array import array

    class Words(dict):
        def __missing__(self, word: str) -> bytes:
            return of_word(word)

    tables = {} if tables is None else tables
    words, cache = Words(tables.get("words", {})), tables.setdefault("parts", {})
    tables["words"] = words
    ids_bytes = lambda ids: array("I", ids).tobytes()  # noqa: E731  four bytes, little-endian on Spark's platforms
    end = ids_bytes([eos_id])
    merges = tokenizer.model.tokenize
    # The split pattern of the vocabulary file, in Latin-1.
    letters, digits, space = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe", "\t\n\r "
    parts = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{digits}]|[^{space}{letters}{digits}]+").findall
    unusual = re.compile("[^\t\n\r -~\xa1-\xac\xae-\xff]|<\\|").search
    # Byte-level BPE shows printable bytes as themselves, others from U+0100 on.
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letter = {x: chr(x) for x in shown} | {x: chr(256 + k) for k, x in enumerate(sorted({*range(256)} - {*shown}))}

    def merged(part: str) -> bytes:
        seen = part if part.isascii() else "".join([letter[x] for x in part.encode()])
        ids = cache[part] = ids_bytes([x.id for x in merges(seen)])
        return ids

    def of_word(word: str) -> bytes:
        if unusual(word):
            ids = ids_bytes(tokenizer.encode(word, add_special_tokens=False).ids)
        else:
            ids = b"".join([cache.get(x) or merged(x) for x in parts(word.lower())])
        words[word] = ids
        return ids

    def encode(text: str) -> bytes:
        if len(words) > most or len(cache) > most:
            words.clear()
            cache.clear()
        return b"".join(map(words.__getitem__, text.replace("\n", " ").split(" "))) + end

    return encode


def worker_tables(name: str) -> dict:
    """A dict of this Python worker, kept between its tasks."""
    import sys
    import types

    kept = sys.modules.setdefault("_strongroom_llm_tables", types.ModuleType("_strongroom_llm_tables"))
    return kept.__dict__.setdefault(name, {})


def pack(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", eos_id: int = 2,
         max_tokens: int = 4096, group_tokens: int = 1 << 20, linear: float = 1.0, quadratic: float = 1 / 4096,
         with_ids: bool = True) -> DataFrame:
    """Pieces of documents and where they lie in the packed sequences.

    Returns per piece: the id column, ``start`` (tokens of the document before
    it), ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``,
    ``offset`` and, ``with_ids``, the token ``ids``.  Null and empty texts
    are the end token alone; repeated rows are documents of their own; null
    ids are carried along; an empty table gives no pieces; ties in length go
    in reading order.  Other columns are not read.
    """
    if max_tokens & (max_tokens - 1):
        raise ValueError("max_tokens must be a power of two")
    key = df.schema[id_col]
    fields = [T.StructField(key.name, key.dataType)] + [
        T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
    schema = T.StructType(fields + ([T.StructField("ids", T.ArrayType(T.IntegerType()))] if with_ids else []))

    def run(batches):
        import os

        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        kept = worker_tables(tokenizer_path)
        if "tokenizer" not in kept:
            kept["tokenizer"] = Tokenizer.from_file(tokenizer_path)
        encode = token_bytes(kept["tokenizer"], eos_id, kept)
        arrow = to_arrow_schema(schema)
        next_id = TaskContext.get().partitionId() << 40
        rows: list[tuple] = []
        waiting: list[tuple] = []  # (doc, start, ids, tokens of the doc)
        tokens = 0

        def put(doc, start, ids, total, seq, offset):
            out = (doc, start, len(ids) // 4, zlib.crc32(ids), total, seq, offset)
            rows.append(out + (np.frombuffer(ids, "<u4").astype(np.int32),) if with_ids else out)

        def flush(least):
            while len(rows) > least:
                part = rows[:8192]
                del rows[:8192]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part), arrow)], schema=arrow)

        def close():
            nonlocal next_id, tokens
            lengths = [len(x[2]) // 4 for x in waiting]
            for i, at, n, k, offset in assign(lengths, max_tokens, linear, quadratic):
                doc, start, ids, total = waiting[i]
                put(doc, start + at, ids[4 * at : 4 * (at + n)], total, next_id + k, offset)
            next_id += len(capacities(tokens, max_tokens))
            waiting.clear()
            tokens = 0

        for batch in batches:
            docs, texts = batch.column(0).to_pylist(), batch.column(1)
            for k in range(0, len(docs), 64):
                for doc, text in zip(docs[k : k + 64], texts[k : k + 64].to_pylist()):
                    ids = encode(text or "")
                    total, cut = len(ids) // 4, len(ids) // 4 // max_tokens * max_tokens
                    for start in range(0, cut, max_tokens):
                        put(doc, start, ids[4 * start : 4 * (start + max_tokens)], total, next_id, 0)
                        next_id += 1
                    if total > cut:
                        waiting.append((doc, cut, ids[4 * cut :], total))
                        tokens += total - cut
                    if tokens >= group_tokens:
                        close()
                yield from flush(8192)
        close()
        yield from flush(0)

    return df.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)
