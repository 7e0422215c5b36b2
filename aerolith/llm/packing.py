"""Sum-of-squares packing of token sequences.

A document becomes its token ids and an end id. Documents longer than the capacity are cut into
full pieces, of which only the first may be shorter. Pieces are placed one after the
other where the sum of squared counts of open bins per residual gap becomes smallest: moving a
bin from gap g to gap g - n changes that sum by a difference that is known for every gap, so a
placement is one look over the gaps, whatever the number of bins. Pieces come longest first, and a new bin is
opened only for a piece that fits none.

Tokens are made inside the tasks that read the texts; only one small row per piece goes on. Full
pieces need no partner and keep to themselves. The others are dealt at random into groups of about
``GROUP`` pieces, each packed by one task, so the work grows with the input and no task sees more
than a group. A group leaves a few bins open, a share that shrinks as ``GROUP`` grows.

Ids are those of the ``tokenizers`` file. For texts whose characters all lie in ranges where letters, digits
and white space have long been fixed, the same vocabulary is applied by ``tiktoken``, which
gives the same ids in about a third of the time; all other texts, and those that contain the string of a
special token, go through ``tokenizers`` itself. The tests hold one against the other.

Defined results: a null or empty text is the end id alone; null ids pass through; repeated rows are
packed as often as they occur; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import base64
import math
import os
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.llm.common import checkpoint, id_text, table

CAPACITY = 1024
END_ID = 2
GROUP = 50_000
#: texts with other characters are encoded by ``tokenizers``
PLAIN = "\x00-\u024f\u2010-\u2027\u20ac"

PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
PACKED_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def vocabulary() -> tuple[str, str]:
    """The vocabulary for ``tokenizers`` and the same as ranks for ``tiktoken``."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


class Encoder:
    """Token ids of texts as little-endian 32-bit bytes."""

    def __init__(self, path: str, ranks_path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        special = [re.escape(t.content) for t in self.tok.get_added_tokens_decoder().values()]
        self.other = re.compile("|".join([f"[^{PLAIN}]", *special]))

    def encode(self, text: str) -> bytes:
        if self.other.search(text):
            return np.array(self.tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False).tobytes()


_encoders: dict[tuple[str, str], Encoder] = {}


def encoder(paths: tuple[str, str]) -> Encoder:
    if paths not in _encoders:
        _encoders[paths] = Encoder(*paths)
    return _encoders[paths]


def _cut(paths: tuple[str, str], capacity: int, end_id: int):
    def run(batches):
        end = np.array([end_id], "<u4").tobytes()
        for b in batches:
            rows: tuple[list, ...] = ([], [], [], [], [])
            encode = encoder(paths).encode
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text")):
                data = encode(text.as_py() or "") + end
                n = len(data) // 4
                at, piece = 0, 0
                size = n if n <= capacity else n % capacity or capacity
                while at < n:
                    for col, v in zip(rows, (doc, piece, at, size, zlib.crc32(data[4 * at:4 * (at + size)]))):
                        col.append(v)
                    at, piece, size = at + size, piece + 1, capacity
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, PIECES)], schema=PIECES)
    return run


def pieces(docs: DataFrame, paths: tuple[str, str] | None = None, capacity: int = CAPACITY, end_id: int = END_ID,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece of every document."""
    return id_text(docs, id_col, text_col).mapInArrow(
        _cut(paths or vocabulary(), capacity, end_id), "doc_id long, piece int, start long, length long, ids_crc32 long")


def place(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece, placed in the given order."""
    n_open = np.zeros(capacity + 1, np.int64)  # open bins by level; full ones are not open
    bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    bin_of, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    never = np.iinfo(np.int64).max
    used = 0
    for k, n in enumerate(lengths.tolist()):
        here = n_open[1:capacity + 1 - n]  # open bins by level h = 1 .. capacity - n: those with room
        change = 2 * n_open[1 + n:] + 1  # what the sum gains at level h + n
        if len(change):
            change[-1] = 0
        change = np.where(here > 0, change + 1 - 2 * here, never)
        h = len(change) - int(np.argmin(change[::-1])) if here.any() else 0  # of equals, the fullest bin
        if h:
            n_open[h] -= 1
            b = bins[h].pop()
        else:
            b, used = used, used + 1
        if h + n < capacity:
            n_open[h + n] += 1
            bins[h + n].append(b)
        bin_of[k], offset[k] = b, h
    return bin_of, offset


def _pack(capacity: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "salt"], ascending=[False, True], kind="stable").reset_index(drop=True)
        bin_of, offset = place(pdf["length"].to_numpy(), capacity)
        group = int(pdf["grp"].iloc[0])
        return pd.DataFrame({"row": pdf["row"], "sequence_id": bin_of + (group << 32), "offset": offset})
    return run


def pack(cut: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """The pieces with sequence_id and offset."""
    rows = checkpoint(cut.withColumn("row", F.monotonically_increasing_id()).withColumn("salt", F.xxhash64("row")))
    full = rows.where(F.col("length") >= capacity).select(*cut.columns, (-1 - F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = rows.where(F.col("length") < capacity)
    groups = max(1, math.ceil(rest.count() / group))
    placed = (rest.select("row", "salt", "length", F.pmod("salt", F.lit(groups)).alias("grp")).groupBy("grp")
              .applyInPandas(_pack(capacity), "row long, sequence_id long, offset long"))
    return rest.join(placed, "row").select(*cut.columns, "sequence_id", "offset").unionByName(full)


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(pieces(table(spark, sf_dir, "documents")))


QUERIES = {"op9_best_fit_packing": op9_best_fit_packing}
SQL: dict[str, str] = {}
