"""Token files: frequency-ranked ids, one to four bytes each, with the sizes
in separate control bytes.

Documents are dealt to shards by ranges of doc_id.  A first pass encodes all
texts and counts every id over the whole corpus; ids are then renumbered by
falling count, so that the frequent ones take a byte.  Each shard's documents,
ascending, become blocks of whole documents: header, document ids and counts,
control bytes (two bits a value: its bytes less one) and data bytes.  Blocks
are read back by table lookup: a control byte names the offsets and masks of
its four values, and numpy gathers them all at once.

Blocks lie in a Parquet folder (shard, block, first id's place, bytes), so any
store that Spark reaches can hold them; the rank table lies beside them and is
bounded by the vocabulary.

Defined cases: a null or empty text is the end id alone; a null doc_id comes
first; repeated rows are written each, rows of one id by their ids' bytes; ids of
equal count rank by number; a very long text is a block of its own; columns
beyond doc_id and text are not read; an empty table gives empty files.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from hazrank.llm.common import documents, map_arrow, shared_folder, shuffle_partitions, staged

VOCABULARY = "word_bpe_49k.json"
END = 2
#: Ids in a block, about; a longer document has a block for itself.
BLOCK_IDS = 1 << 16
MAGIC = b"RVB1"
_BYTES = np.array([[((c >> (2 * k)) & 3) + 1 for k in range(4)] for c in range(256)], dtype=np.uint8)
_BEFORE = np.concatenate([np.zeros((256, 1), np.int64), np.cumsum(_BYTES[:, :3], axis=1, dtype=np.int64)], axis=1)
_TOTAL = _BYTES.sum(axis=1).astype(np.int64)
_MASK = np.array([0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], dtype=np.uint32)


def encode_values(v: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of unsigned 32-bit values."""
    v = np.ascontiguousarray(v, dtype="<u4")
    size = 1 + (v > 0xFF) + (v > 0xFFFF) + (v > 0xFFFFFF)
    code = np.zeros(-(-len(v) // 4) * 4, dtype=np.uint8)
    code[:len(v)] = size - 1
    code = code.reshape(-1, 4)
    control = code[:, 0] | code[:, 1] << 2 | code[:, 2] << 4 | code[:, 3] << 6
    return control.astype(np.uint8).tobytes(), v.view(np.uint8).reshape(-1, 4)[np.arange(4) < size[:, None]].tobytes()


def decode_values(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The values again, all at once by table lookup."""
    c = np.frombuffer(control, dtype=np.uint8)
    groups = np.concatenate([[0], np.cumsum(_TOTAL[c])])[:-1]
    at = (groups[:, None] + _BEFORE[c]).reshape(-1)[:n]
    size = _BYTES[c].reshape(-1)[:n]
    # the four bytes from every place on, overlapping
    word = np.ndarray(len(data), dtype="<u4", buffer=data + b"\0\0\0", strides=(1,))
    return word[at] & _MASK[size - 1]


def write_block(doc_ids: list, counts: list[int], ranks: np.ndarray) -> bytes:
    """A block of whole documents."""
    control, data = encode_values(ranks)
    known = np.array([d is not None for d in doc_ids], dtype=np.uint8).tobytes()
    ids = np.array([d or 0 for d in doc_ids], dtype="<i8").tobytes()
    return b"".join([struct.pack("<4sIQQQ", MAGIC, len(doc_ids), len(ranks), len(control), len(data)), known, ids, np.array(counts, dtype="<u8").tobytes(), control, data])


def read_block(block: bytes) -> tuple[list, np.ndarray, np.ndarray]:
    """Document ids, counts and ranks of a block."""
    magic, n, total, n_control, n_data = struct.unpack_from("<4sIQQQ", block)
    if magic != MAGIC:
        raise ValueError("not a token block")
    at = struct.calcsize("<4sIQQQ")
    known = np.frombuffer(block, np.uint8, n, at)
    ids = np.frombuffer(block, "<i8", n, at + n).tolist()
    counts = np.frombuffer(block, "<u8", n, at + 9 * n).astype(np.int64)
    at += 17 * n
    ranks = decode_values(block[at:at + n_control], block[at + n_control:at + n_control + n_data], total)
    return [d if k else None for d, k in zip(ids, known)], counts, ranks


def id_ranks(ids: DataFrame, kind: str) -> np.ndarray:
    """Ids by falling count over the whole corpus, ties by id; unseen ids
    follow.  At most one number for each id of the vocabulary."""

    def counts(batches):
        total = np.zeros(0, dtype=np.int64)
        for b in batches:
            held = b.column(0).to_pylist()
            for k in range(0, len(held), 1000):
                c = np.bincount(np.frombuffer(b"".join(held[k:k + 1000]), kind))
                if len(c) > len(total):
                    total = np.concatenate([total, np.zeros(len(c) - len(total), np.int64)])
                total[:len(c)] += c
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["id", "n"])

    rows = map_arrow(ids.select("ids"), counts, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    rows.sort(key=lambda r: (-r["n"], r["id"]))
    return np.array([r["id"] for r in rows], dtype=np.uint32)


def write_token_files(docs: DataFrame, name: str = VOCABULARY, end: int = END, block_ids: int = BLOCK_IDS) -> str:
    """Encode ``docs`` and write the files; the folder's path."""
    from hazrank.llm.tokens import id_bytes, vocabulary
    spark = docs.sparkSession
    kind = f"<u{id_bytes(vocabulary(name))}"

    def encode(batches):
        from hazrank.llm.tokens import encoded
        for b in batches:
            ids = [np.frombuffer(x, "<u4").astype(kind) for x in encoded(b.column(1), name, False, end)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x.tobytes() for x in ids], pa.binary()), pa.array([len(x) for x in ids], pa.int64())], ["doc_id", "ids", "n"])

    ids = staged(map_arrow(docs.select(F.col("doc_id").cast("long"), "text"), encode, "doc_id long, ids binary, n long"), "zstd")
    by_rank = id_ranks(ids, kind)
    rank_of = np.zeros(int(by_rank.max()) + 1 if len(by_rank) else 1, dtype=np.uint32)
    rank_of[by_rank] = np.arange(len(by_rank), dtype=np.uint32)

    shards = shuffle_partitions(spark)
    bounds = ids.approxQuantile("doc_id", [k / shards for k in range(1, shards)], 0.2 / shards) if shards > 1 else []
    bounds = sorted({int(x) for x in bounds})
    # the number of bounds at or below the id; a null id goes first
    shard = F.coalesce(F.size(F.filter(F.array(*[F.lit(x) for x in bounds]), lambda x: x <= F.col("doc_id"))), F.lit(0)) if bounds else F.lit(0)
    ids = ids.withColumn("shard", F.when(F.col("doc_id").isNull(), 0).otherwise(shard).cast("int"))
    totals = {r["shard"]: r["n"] for r in ids.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    first, at = {}, 0
    for k in sorted(totals):
        first[k], at = at, at + totals[k]

    def blocks(batches):
        now, block, place, held, size = None, 0, 0, [], 0
        width = np.dtype(kind).itemsize

        def out():
            ranks = rank_of[np.frombuffer(b"".join(x[1] for x in held), kind)]
            raw = write_block([x[0] for x in held], [len(x[1]) // width for x in held], ranks)
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([block], pa.int64()), pa.array([place], pa.int64()), pa.array([raw], pa.binary())], ["shard", "block", "first", "bytes"])

        for b in batches:
            for s, d, raw in zip(*(c.to_pylist() for c in b.columns)):
                if held and (s != now or size >= block_ids):
                    yield out()
                    block, place, held, size = block + 1, place + size, [], 0
                if s != now:
                    now, block, place = s, 0, first[s]
                held.append((d, raw))
                size += len(raw) // width
        if held:
            yield out()

    dealt = ids.select("shard", "doc_id", "ids").repartitionById(shards, F.col("shard"))
    dealt = dealt.sortWithinPartitions("shard", F.col("doc_id").asc_nulls_first(), "ids")
    path = shared_folder(spark)
    map_arrow(dealt, blocks, "shard int, block long, first long, bytes binary").write.option("compression", "zstd").parquet(f"{path}/blocks")
    spark.createDataFrame(pa.table({"rank": pa.array(np.arange(len(by_rank)), pa.int64()), "id": pa.array(by_rank.astype(np.int64))})).write.parquet(f"{path}/ranks")
    return path


def read_token_files(spark, path: str, each=None, columns: str = "ids binary") -> DataFrame:
    """Per document: ``doc_id, start`` (ids before it) and ``columns``: its
    ids, or what ``each`` makes of their bytes (a tuple for ``columns``), so
    that a reader who wants less need not move them."""
    rows = sorted(spark.read.schema("rank long, id long").parquet(f"{path}/ranks").collect())
    id_of = np.array([r["id"] for r in rows], dtype="<u4")
    schema = f"doc_id long, start long, {columns}"
    kinds = to_arrow_schema(StructType.fromDDL(schema))

    def read(batches):
        for b in batches:
            for at, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                doc_ids, counts, ranks = read_block(raw)
                ids = memoryview(id_of[ranks]).cast("B")
                ends = np.cumsum(counts)
                starts = ends - counts
                parts = [ids[4 * x:4 * y] for x, y in zip(starts.tolist(), ends.tolist())]
                made = list(zip(*map(each, parts))) if each else [[p.tobytes() for p in parts]]
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip([doc_ids, starts + at, *made], kinds)], kinds.names)

    blocks = spark.read.schema("shard int, block long, first long, bytes binary").parquet(f"{path}/blocks")
    return map_arrow(blocks.select("first", "bytes"), read, schema)


def op8_token_files(spark, sf_dir: str) -> DataFrame:
    """Contract query: what the files hold of each document."""
    path = write_token_files(documents(spark, sf_dir))
    return read_token_files(spark, path, lambda ids: (len(ids) // 4, zlib.crc32(ids)), "n_tokens long, ids_crc32 long")
