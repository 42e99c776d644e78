"""Questions and answers between batches of documents and shards of a key space.

Documents are dealt into batches by a hash.  A batch asks each shard about
its distinct fingerprints in one packed message, and a shard answers each
batch in one packed message.  So a fingerprint that a third of all documents
hold costs one entry per batch, not one per document: no key is hot, no
group is expanded, and nothing passes the driver.  Messages are Spark rows
(address, sender, payload); Spark shuffles and recomputes them.  Payloads
are numpy arrays, compressed with zstandard.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BATCH = "__tf_batch"
MESSAGES = "__tf_to int, __tf_from int, __tf_payload binary"
_SCHEMA = pa.schema([("__tf_to", pa.int32()), ("__tf_from", pa.int32()), ("__tf_payload", pa.binary())])
BATCH_BYTES = 10 << 20
LEAST_BATCHES = 64
LAST_ID = np.iinfo(np.int64).max


def pack(*arrays: np.ndarray) -> bytes:
    """One binary of several arrays."""
    z = zstandard.ZstdCompressor(level=1)
    head, body = [struct.pack("<B", len(arrays))], []
    for a in arrays:
        b = z.compress(np.ascontiguousarray(a).tobytes())
        head.append(struct.pack("<3sq", a.dtype.str[1:].encode().ljust(3), len(b)))
        body.append(b)
    return b"".join(head + body)


def unpack(payload: bytes) -> list[np.ndarray]:
    z, out = zstandard.ZstdDecompressor(), []
    n, at = payload[0], 1 + 11 * payload[0]
    for i in range(n):
        kind, size = struct.unpack_from("<3sq", payload, 1 + 11 * i)
        out.append(np.frombuffer(z.decompress(payload[at : at + size]), np.dtype("<" + kind.decode().strip())))
        at += size
    return out


def messages(rows: list[tuple[int, int, bytes]]) -> pa.Table:
    to, sender, payload = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.table([pa.array(to, pa.int32()), pa.array(sender, pa.int32()), pa.array(payload, pa.binary())], schema=_SCHEMA)


def deal(shard: np.ndarray, n: int, sender: int, *arrays: np.ndarray) -> pa.Table:
    """Messages to ``n`` shards, given the shard of each entry."""
    order = np.argsort(shard.astype(np.uint32), kind="stable")
    edges = np.searchsorted(shard[order], np.arange(n + 1))
    arrays = [a[order] for a in arrays]
    return messages([(k, sender, pack(*(a[edges[k] : edges[k + 1]] for a in arrays))) for k in range(n) if edges[k + 1] > edges[k]])


def received(table: pa.Table) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(sender, arrays) of each message."""
    for sender, payload in zip(table.column("__tf_from").to_pylist(), table.column("__tf_payload"), strict=True):
        yield sender, unpack(payload.as_buffer().to_pybytes())


def gather(table: pa.Table) -> tuple[np.ndarray, list[np.ndarray]]:
    """All messages joined: the sender of each entry, and the arrays."""
    got = list(received(table))
    if not got:
        return np.zeros(0, np.int32), []
    senders = np.repeat([s for s, _ in got], [len(a[0]) for _, a in got])
    return senders, [np.concatenate(x) for x in zip(*(a for _, a in got), strict=True)]


def reply(senders: np.ndarray, me: int, *arrays: np.ndarray) -> pa.Table:
    """Messages back to each sender, given the addressee of each entry."""
    if not len(senders):
        return messages([])
    order = np.argsort(senders, kind="stable")
    senders, arrays = senders[order], [a[order] for a in arrays]
    cuts = np.flatnonzero(np.r_[True, senders[1:] != senders[:-1]])
    ends = np.r_[cuts[1:], len(senders)]
    return messages([(int(senders[a]), me, pack(*(x[a:b] for x in arrays))) for a, b in zip(cuts, ends, strict=True)])


def text_size(docs: DataFrame, text: str = "text") -> int:
    """Bytes of all texts (one pass over one column)."""
    return int(docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0)


def batched(docs: DataFrame, total: int, doc_id: str = "doc_id", text: str = "text",
            batch_bytes: int = BATCH_BYTES) -> tuple[DataFrame, int]:
    """The documents with a batch number, and how many batches there are."""
    n = max(LEAST_BATCHES, -(-total // batch_bytes))
    return docs.withColumn(BATCH, F.pmod(F.xxhash64(F.col(doc_id), F.col(text)), F.lit(n)).cast("int")), n


def ask(docs: DataFrame, fn: Callable[[int, pa.Table], pa.Table]) -> DataFrame:
    """Run ``fn(batch, documents)`` on each batch; it returns messages."""
    return docs.groupBy(BATCH).applyInArrow(lambda key, t: fn(key[0].as_py(), t), MESSAGES)


def answer(asked: DataFrame, fn: Callable[[int, pa.Table], pa.Table]) -> DataFrame:
    """Run ``fn(shard, messages)`` on each shard; it returns messages."""
    return asked.groupBy("__tf_to").applyInArrow(lambda key, t: fn(key[0].as_py(), t), MESSAGES)


def read_answers(docs: DataFrame, answers: DataFrame, fn: Callable[[int, pa.Table, pa.Table], pa.Table],
                 schema: str) -> DataFrame:
    """Run ``fn(batch, documents, messages)`` on each batch that has documents."""
    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        return fn(key[0].as_py(), left, right)

    return docs.groupBy(BATCH).cogroup(answers.groupBy("__tf_to")).applyInArrow(run, schema)


def ids(table: pa.Table, doc_id: str = "doc_id") -> np.ndarray:
    """Ids as int64; a null id counts as larger than any other."""
    return table.column(doc_id).combine_chunks().cast(pa.int64()).fill_null(LAST_ID).to_numpy(zero_copy_only=False)
