"""Placement of documents on shards by a permutation-filled lookup table.

Every shard has its own permutation of the slots of a table of prime size. The shards take turns; each claims the next
slot of its permutation that is still free, until all are taken. So shards hold equal numbers of slots (to one), and a
shard that comes or goes moves little more than its own share. A document's slot is a hash of its key modulo the size;
the table, of a fixed number of rows, is broadcast.

A null doc_id is placed by its text (rows without a text, and tables without that column, all have one place then).
Repeated rows come to the same shard; texts of any length, null or empty, play no part where there is an id. There are
no ties: each slot has one shard. An empty table gives an empty result. Extra columns stay; `slot` and `shard` are
replaced. An empty list of shards, or one with a name twice, is an error.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Prime; 100 and more slots for each of up to 650 shards keep shares within 1 %.
TABLE_SIZE = 65537
SHARDS = 64


def is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n**0.5) + 1))


def _preference(name: str, size: int) -> tuple[int, int]:
    digest = hashlib.sha256(name.encode()).digest()
    return int.from_bytes(digest[:8], "big") % size, int.from_bytes(digest[8:16], "big") % (size - 1) + 1


def lookup_table(shards: list[str], size: int = TABLE_SIZE) -> np.ndarray:
    """The number of the shard that holds each slot."""
    if not is_prime(size):
        raise ValueError("the table's size must be prime, so that each step visits every slot")
    if not 0 < len(shards) <= size or len(set(shards)) < len(shards):
        raise ValueError("shards need distinct names, and a slot each")
    at, step = (np.array(x, dtype=np.int64) for x in zip(*(_preference(s, size) for s in shards), strict=True))
    at, step = at.tolist(), step.tolist()
    owner = [-1] * size
    left = size
    while left:
        for s in range(len(at)):
            slot = at[s]
            while owner[slot] >= 0:
                slot = (slot + step[s]) % size
            owner[slot] = s
            at[s] = (slot + step[s]) % size
            left -= 1
            if not left:
                break
    return np.array(owner, dtype=np.int32)


def place(docs: DataFrame, shards: int | list[str] = SHARDS, size: int = TABLE_SIZE, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with two more columns, `slot` and `shard` (its number); columns of these names are replaced."""
    import pandas as pd

    names = [f"shard-{k}" for k in range(shards)] if isinstance(shards, int) else list(shards)
    spark = docs.sparkSession
    table = spark.createDataFrame(pd.DataFrame({"slot": np.arange(size, dtype=np.int32), "shard": lookup_table(names, size)}), "slot int, shard int")
    by_text = F.col(text).cast("string") if text in docs.columns else F.lit(None).cast("string")
    hashed = F.when(F.col(key).isNotNull(), F.xxhash64(F.col(key).cast("string"))).otherwise(F.xxhash64(F.lit("null"), by_text))
    docs = docs.drop("slot", "shard").withColumn("slot", F.pmod(hashed, F.lit(size)).cast("int"))
    kept = [c for c in docs.columns if c != "slot"]
    return docs.join(F.broadcast(table), "slot").select(*kept, "slot", "shard")
