"""Token sequences of a fixed length, filled so that their attention costs stay close."""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEQUENCE = 1024
#: Tokens that are packed together at least; a task holds about this many, and one document more.
PACK_TOKENS = 1 << 20
END_ID = 0
#: Outside these characters the two libraries' Unicode tables might differ.
_PLAIN = re.compile(r"[^\t\n\r -~¡-ɏ]")
_SPECIAL = "<|endoftext|>"


def encoder() -> Callable[[list[str]], list[np.ndarray]]:
    """Ids of ``byte_bpe_50k.json`` by tokenizers. Plain texts take the same vocabulary through
    tiktoken, which gives the same ids several times as fast."""
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    fast = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))

    def one(text: str) -> np.ndarray:
        if _SPECIAL in text or _PLAIN.search(text):
            return np.array(exact.encode(text, add_special_tokens=False).ids, "<u4")
        return np.array(fast.encode_ordinary(text), "<u4")

    return lambda texts: [np.append(one(text), np.uint32(END_ID)).astype("<u4") for text in texts]


def cost(length: np.ndarray | int, sequence: int = SEQUENCE) -> np.ndarray | float:
    """What a piece costs: linear in its tokens, and quadratic as they attend to each other. At a
    full sequence both count the same."""
    return length + length * length / sequence


def capacities(total: int, sequence: int = SEQUENCE) -> np.ndarray:
    """Full sequences, and for what is left over powers of two, which need no padding."""
    full, rest = divmod(total, sequence)
    return np.array([sequence] * full + [1 << i for i in range(rest.bit_length() - 1, -1, -1) if rest >> i & 1], np.int64)


def pack(lengths: np.ndarray, sequence: int = SEQUENCE) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of documents of ``lengths`` tokens.

    Documents longer than a sequence first give whole sequences. What is left is taken in descending
    cost, each to the cheapest sequence that has room for all of it; when none has, the roomiest
    takes what fits and the rest goes on. The sequences' capacities add up to the tokens, so none is
    padded.
    """
    room = capacities(int(lengths.sum()), sequence)
    spent, used = np.zeros(len(room)), np.zeros(len(room), np.int64)
    pieces, at = [], 0
    for doc in np.nonzero(lengths >= sequence)[0]:
        for start in range(0, int(lengths[doc]) - sequence + 1, sequence):
            pieces.append((int(doc), start, sequence, at, 0))
            at += 1
    room[:at] = 0
    used[:at] = sequence
    spent[:at] = cost(sequence, sequence)
    rest = lengths % sequence
    for doc in np.argsort(-rest, kind="stable"):
        start, left = int(lengths[doc] - rest[doc]), int(rest[doc])
        while left:
            fits = room >= left
            if fits.any():
                k = int(np.where(fits, spent, np.inf).argmin())
            else:
                k = int(room.argmax())
            size = min(left, int(room[k]))
            pieces.append((int(doc), start, size, k, int(used[k])))
            room[k] -= size
            used[k] += size
            spent[k] += cost(size, sequence)
            start, left = start + size, left - size
    return pieces


def pack_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    sequence: int = SEQUENCE,
    pack_tokens: int = PACK_TOKENS,
    with_ids: bool = False,
) -> DataFrame:
    """Pack all documents into sequences of ``sequence`` tokens.

    Returns one row a piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and
    with ``with_ids`` the ids themselves. A document is its text's ids and an end id, so a null or
    empty text has one token. Documents are tokenized and packed where they are read, in groups of
    about ``pack_tokens`` tokens: nothing is shuffled, and a group's cost is balanced among its own
    sequences. ``sequence_id`` holds the partition and a count, so a task that runs again over the
    same partition gives the same ids. Repeated rows and null ids are packed like others; an empty
    table gives no rows. Other columns are not read.
    """
    source = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")
    )
    longs = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    schema = T.StructType(
        [source.schema["doc_id"], *[T.StructField(c, T.LongType()) for c in longs]]
        + [T.StructField("ids", T.ArrayType(T.IntegerType()))] * with_ids
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, base, kind = encoder(), TaskContext.get().partitionId() << 32, None
        held: list[tuple[object, np.ndarray]] = []
        tokens = packed = 0

        def flush() -> pa.RecordBatch:
            nonlocal packed
            lengths = np.array([len(ids) for _, ids in held], np.int64)
            pieces = pack(lengths, sequence)
            crcs = [zlib.crc32(held[d][1][s : s + n].tobytes()) for d, s, n, _, _ in pieces]
            doc, start, length, seq, offset = np.array(pieces, np.int64).T
            columns = [pa.array([held[d][0] for d in doc.tolist()], kind)]
            columns += [pa.array(c, pa.int64()) for c in (start, length, crcs, lengths[doc], base + packed + seq, offset)]
            if with_ids:
                columns.append(pa.array([held[d][1][s : s + n].astype(np.int32) for d, s, n, _, _ in pieces], pa.list_(pa.int32())))
            packed += int(seq.max()) + 1
            return pa.RecordBatch.from_arrays(columns, schema.names)

        for batch in batches:
            kind = batch.column(0).type
            texts = batch.column(1)
            for name, text in zip(batch.column(0).to_pylist(), texts):
                ids = encode([text.as_py()])[0]
                held.append((name, ids))
                tokens += len(ids)
                if tokens >= pack_tokens:
                    yield flush()
                    held, tokens = [], 0
        if held:
            yield flush()

    return source.mapInArrow(run, schema)
