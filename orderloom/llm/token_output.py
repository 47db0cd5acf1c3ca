"""Training-order materialisation: every sequence gets a global slot by a keyed permutation and is written at a fixed place.

A Feistel network with cycle-walking permutes the numbers of the sequences inside a fixed span without any table. As the permuted numbers are
even over the span, the splitters of the range partitions are known beforehand: a shard is a range of them and one task's file. A
sequence's slot is its rank in that order: the shard's first slot, from the manifest, and its place in the shard. A record is its number of tokens (4 bytes)
and ``seq_len`` ids, padded, so place p lies at p * stride: readers start at any slot. Sequences go from the tokenizer through one shuffle into
the shards; they are not stored in between. A write makes a run of its own below the folder; its manifest commits it, and readers see the last run that was committed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderloom.llm.common import cut_lineage, partitions
from orderloom.llm.files import Committed, filesystem
from orderloom.sources.folders import committed, matching, number, remove

MANIFEST = "shard long, file string, first_slot long, records long, file_bytes long, stride long, width int"
ROUNDS = 6
#: Numbers of rows are hashes of 61 bits, below this span.
SPAN = 3 << 60


def permute(numbers: np.ndarray, total: int, key: int) -> np.ndarray:
    """A bijection of 0 to ``total`` - 1."""
    half = max(1, (max(total - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(half), x & mask
        for r in range(ROUNDS):
            mixed = (right + np.uint64((key * ROUNDS + r) % (1 << 64))) * np.uint64(0x9E3779B97F4A7C15)
            mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
            left, right = right, left ^ ((mixed ^ (mixed >> np.uint64(32))) & mask)
        return (left << np.uint64(half)) | right

    out = once(numbers.astype(np.uint64))
    while (beyond := out >= total).any():
        out[beyond] = once(out[beyond])
    return out.astype(np.int64)


def training_order(number: Column, key: int) -> Column:
    """The permuted number, from 0 to SPAN - 1."""

    @F.pandas_udf("long")
    def order(numbers: pd.Series) -> pd.Series:
        return pd.Series(permute(numbers.to_numpy(), SPAN, key))

    return order(number)


def write(sequences: DataFrame, folder: str, key: int, seq_len: int, keys: list[str], shards: int | None = None, width: int = 2, pad_id: int = 0, ids: str = "ids") -> DataFrame:
    """Write ``sequences`` to shards below ``folder``; return the index: ``keys``, ``length``, ``slot``, ``shard`` and ``byte_offset``.

    ``ids`` are little-endian numbers of ``width`` bytes; null is an empty sequence, more than ``seq_len`` tokens are an error. A row's number is a hash
    of its ``keys`` and ids, so the order hangs on the rows and on ``key`` alone, not on files, splits or tasks; rows of equal numbers lie by keys and ids, and repeated
    rows, sequences of their own, side by side. An empty table gives no shard and an empty index.

    A folder may be used again, with any key and rows: shards of a run that broke off are never read, and a commit removes all runs but the one before.
    """
    spark = sequences.sparkSession
    shards, stride = shards or partitions(spark), 4 + seq_len * width
    own = [F.col(k) for k in keys]
    hashed = F.xxhash64(*own, F.coalesce(F.col(ids), F.lit(b"")))
    numbered = sequences.select(*own, F.coalesce(ids, F.lit(b"")).alias("_ids"), F.shiftrightunsigned(hashed, 3).alias("_number"))
    ordered = numbered.withColumn("_order", training_order(F.col("_number"), key)).drop("_number")
    # Both shifted so that the product fits.
    shard = F.expr(f"cast(shiftright(_order, 24) * {shards} div {SPAN >> 24} as int)")
    dealt = ordered.withColumn("_shard", shard).repartitionById(shards, "_shard").sortWithinPartitions("_order", *own, "_ids")
    run_number = max((number(p) for p in matching(spark, f"{folder}/shards/run=*")), default=0) + 1
    place = f"{folder}/shards/run={run_number}"
    schema = dealt.select(*own, F.lit(0).cast("long").alias("length"), F.lit(0).cast("long").alias("shard"), F.lit(0).cast("long").alias("place")).schema

    def run(parts: Iterator) -> Iterator:
        import pyarrow as pa

        out, records = None, 0
        for part in parts:
            if not part.num_rows:
                continue
            shard_number = part.column("_shard")[0].as_py()
            out = out or Committed(f"{place}/shard-{shard_number:06d}.bin")
            sizes = []
            for data in part.column("_ids").to_pylist():
                size = len(data) // width
                if size > seq_len:
                    raise ValueError(f"a sequence of {size} tokens does not fit {seq_len}")
                sizes.append(size)
                out.write(size.to_bytes(4, "little") + data + np.full(seq_len - size, pad_id, dtype=f"<u{width}").tobytes())
            places = np.arange(records, records + len(sizes))
            records += len(sizes)
            arrays = [pa.array(sizes, pa.int64()), pa.array(np.full(len(sizes), shard_number), pa.int64()), pa.array(places, pa.int64())]
            yield pa.RecordBatch.from_arrays([*(part.column(k) for k in keys), *arrays], names=[*keys, "length", "shard", "place"])
        if out is not None:
            out.commit()

    index = cut_lineage(dealt.select(*own, "_ids", "_shard").mapInArrow(run, schema), "index")
    counts = index.groupBy("shard").agg(F.count("*").alias("records"))
    # One row per shard.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    manifest = counts.select(
        "shard", F.format_string(f"shards/run={run_number}/shard-%06d.bin", "shard").alias("file"), F.coalesce(F.sum("records").over(before), F.lit(0)).alias("first_slot"), "records",
        (F.col("records") * stride).alias("file_bytes"), F.lit(stride).cast("long").alias("stride"), F.lit(width).alias("width"),
    )
    manifest.write.mode("overwrite").parquet(f"{folder}/manifest/run={run_number}")
    for old in (p for kind in ("shards", "manifest") for p in matching(spark, f"{folder}/{kind}/run=*")):
        if number(old) < max((r for r in committed(spark, f"{folder}/manifest/run=*") if r < run_number), default=run_number):
            remove(spark, old)
    first = _manifest(spark, folder).select("shard", "first_slot")
    found = index.join(first, "shard")
    return found.select(*keys, "length", (F.col("first_slot") + F.col("place")).alias("slot"), "shard", (F.col("place") * stride).alias("byte_offset"))


def _manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The shards of the last committed run."""
    runs = committed(spark, f"{folder}/manifest/run=*")
    if not runs:
        raise FileNotFoundError(f"{folder} holds no committed run")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest/run={max(runs)}")


def read(spark: SparkSession, folder: str, from_slot: int = 0) -> DataFrame:
    """``slot``, ``shard``, ``byte_offset``, ``length`` and ``ids`` from a slot on, each shard read in sequence."""
    manifest = _manifest(spark, folder)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for m in part.itertuples():
                system, path = filesystem(f"{folder}/{m.file}")
                at = max(from_slot - m.first_slot, 0)
                with system.open_input_file(path) as file:
                    file.seek(at * m.stride)
                    while at < m.records:
                        n = min(4096, m.records - at)
                        block = np.frombuffer(file.read(n * m.stride), np.uint8).reshape(n, m.stride)
                        sizes = block[:, :4].copy().view("<u4")[:, 0].astype(np.int64)
                        yield pd.DataFrame(
                            {
                                "slot": m.first_slot + at + np.arange(n),
                                "shard": m.shard,
                                "byte_offset": (at + np.arange(n)) * m.stride,
                                "length": sizes,
                                "ids": [row[4 : 4 + size * m.width].tobytes() for row, size in zip(block, sizes, strict=True)],
                            }
                        )
                        at += n

    files = manifest.where(F.col("first_slot") + F.col("records") > from_slot).repartition(partitions(spark))
    return files.mapInPandas(run, "slot long, shard long, byte_offset long, length long, ids binary")
