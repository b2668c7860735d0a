"""Bloom filters of a batch's keys, which spare most rows of a giant table the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bits of the filter per key, and of a word that a key sets.
BITS_PER_KEY, MARKS = 16, 3
#: The filter's words are broadcast up to this many bytes; fuller filters only let more rows through.
MOST_BYTES = 64 << 20
#: Bytes of a word in a broadcast table, and of a key besides its own.
WORD_BYTES, KEY_BYTES = 48, 48


def broadcast_bytes(spark: SparkSession) -> int:
    """The size up to which the session broadcasts a side of a join; negative if it never does."""
    sizes = {"b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30}
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10m").lower().removesuffix("b") or "0"
    unit = text[-1] if text[-1] in sizes else "b"
    return int(text.rstrip("kmg")) * sizes[unit]


def _marks(key: str) -> Column:
    """Some bits of one word."""
    places = [F.pmod(F.xxhash64(key, F.lit(k)), F.lit(64)).cast("int") for k in range(MARKS)]
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"), place) for place in places]
    mask = bits[0]
    for bit in bits[1:]:
        mask = mask.bitwiseOR(bit)
    return mask


def filter_words(keys: DataFrame, key: str, number: int, most_bytes: int = MOST_BYTES) -> tuple[DataFrame, int]:
    """``(word, marks)`` of the filter over about ``number`` keys, and how many words it could have.

    Words are merged where the keys lie before they are shuffled; there are at most ``most_bytes`` of them.
    """
    words = max(1, min(number * BITS_PER_KEY // 64 + 1, most_bytes // WORD_BYTES))
    word = F.pmod(F.xxhash64(key), F.lit(words))
    return keys.groupBy(word.alias("_word")).agg(F.bit_or(_marks(key)).alias("_marks")), words


def marked(table: DataFrame, keys: DataFrame, key: str, number: int, most_bytes: int = MOST_BYTES) -> DataFrame:
    """``table`` with ``_may``: false for rows whose key is surely not in ``keys``, or null.

    The table is not shuffled: the words are broadcast, at most ``most_bytes`` of them.
    """
    words, many = filter_words(keys, key, number, most_bytes)
    found = table.withColumn("_at", F.pmod(F.xxhash64(key), F.lit(many)))
    found = found.join(F.broadcast(words), F.col("_at") == F.col("_word"), "left")
    mask = _marks(key)
    may = F.col(key).isNotNull() & F.coalesce(F.col("_marks").bitwiseAND(mask) == mask, F.lit(False))
    return found.select(*table.columns, may.alias("_may"))
