"""Words and word shingles as DataFrame expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words of a shingle.
WIDTH = 5
SPACES = " \t\n\x0b\x0c\r"


def words(text: Column) -> Column:
    """Lower-cased words between white space (space, tab to carriage return); null and blank: none."""
    trimmed = F.btrim(F.lower(F.coalesce(text, F.lit(""))), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\t-\r]+"))


def with_shingle_hashes(df: DataFrame, words_col: str, out: str, width: int = WIDTH, also: tuple[int, ...] = ()) -> DataFrame:
    """Add the 64-bit hashes of the shingles of ``words_col`` (with repeats, in order).

    With fewer words than ``width`` the whole sequence is the one shingle; no words, none. Behind them come
    the runs of each width in ``also``: they are what shorter texts are found by.
    """
    hashed = df.withColumn("_h", F.transform(words_col, lambda w: F.xxhash64(w)))
    h, n = F.col("_h"), F.size("_h")

    def at(w: int):
        # a place behind the last word is null, which leaves the hash as it is
        return lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(w)])

    def runs(w: int) -> Column:
        return F.when(n >= w, F.transform(F.sequence(F.lit(0), n - w), at(w)))

    none = F.array().cast("array<long>")
    found = F.coalesce(runs(width), F.when(n > 0, F.array(at(width)(F.lit(0)))), none)
    more = [F.coalesce(runs(w), none) for w in also]
    return hashed.withColumn(out, F.concat(found, *more) if more else found).drop("_h")


def shingle_texts(words_col: Column, width: int = WIDTH, also: tuple[int, ...] = ()) -> Column:
    """The distinct shingles themselves, words joined by one space, and the runs of each width in ``also``."""
    n, none = F.size(words_col), F.array().cast("array<string>")

    def runs(w: int) -> Column:
        return F.when(n >= w, F.transform(F.sequence(F.lit(1), n - (w - 1)),
                                          lambda i: F.array_join(F.slice(words_col, i, w), " ")))

    found = F.coalesce(runs(width), F.when(n > 0, F.array(F.array_join(words_col, " "))), none)
    more = [F.coalesce(runs(w), none) for w in also]
    return F.array_distinct(F.concat(found, *more) if more else found)
