"""Small shared helpers of the training-data operators."""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.session import cut_lineage, prepare

#: a table is broadcast only when its measured row count stays below this
BROADCAST_ROWS = 200_000
#: words kept in a task's word cache before it starts anew
CACHE_WORDS = 1 << 20

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: a word is a run of anything but the ASCII blanks 0x20 and 0x09 to 0x0D
BLANK_WORD = r"[^\x20\x09-\x0D]+"

GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_S30, _S27, _S31 = np.uint64(30), np.uint64(27), np.uint64(31)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back."""
    return cut_lineage(df, label)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` (a saved table) with a broadcast hint if it is measured to be small, else as it is."""
    return F.broadcast(df) if df.count() <= rows else df


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else; the short way for texts that are ASCII throughout."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, ASCII_UPPER, ASCII_UPPER.lower())
    )


def mixed(x: np.ndarray) -> np.ndarray:
    """Finalising 64-bit mix, element by element."""
    x = (x ^ (x >> _S30)) * _M1
    x = (x ^ (x >> _S27)) * _M2
    return x ^ (x >> _S31)


class WordHashes(dict):
    """64-bit hashes of words (bytes), kept for the words seen lately."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def utf8(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
