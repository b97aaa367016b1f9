"""An exact stratified train/test split without sorting the rows.

Rows are ordered by a hash of their key.  The test rows of a class are those up to a cut, and the cut
is found by counting: rows per class and hash range, then the same inside the one range in which the
wanted count is reached, until a range ends exactly there.  With ranges of ``DIGITS`` hex digits, two
rounds are enough up to some 2 ** 32 rows of a class.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import SEED, TEST_SHARE

#: Hex digits by which a round narrows the range: at most 16 ** DIGITS counts per class.
DIGITS = 4
HASH_DIGITS = 32


def split_hash(key: str, seed: int = SEED) -> Column:
    """The md5 of the key's text and the seed, as hex; a null key counts as empty text."""
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    return F.md5(F.concat(text, F.lit(f"-{seed}")).cast("binary"))


def _per_class(values: dict, label: Column, default) -> Column:
    out = F.lit(default)
    for value, found in values.items():
        out = F.when(label.eqNullSafe(F.lit(value)), F.lit(found)).otherwise(out)
    return out


def class_cuts(
    df: DataFrame, label: str, key: str, share: float = TEST_SHARE, seed: int = SEED, digits: int = DIGITS
) -> dict:
    """For each class the hash prefix up to which its rows are test rows; None where there are none.

    ``round(share * rows)`` rows of a class are wanted, halves up.  Rows that repeat a key are not
    parted: if the cut falls among them, all of them are test rows.  One row per class and round
    reaches the driver.  Each round reads the label and the key, so pass a table or a pinned frame.
    """
    hashed = df.select(F.col(label).alias("label"), split_hash(key, seed).alias("hash"))
    own, up_to = Window.partitionBy("label"), Window.partitionBy("label").orderBy("range")
    cuts, prefixes, missing = {}, {}, {}
    rows, depth = hashed, 0
    while depth < HASH_DIGITS:
        depth = min(depth + digits, HASH_DIGITS)
        counts = rows.groupBy("label", F.substring("hash", 1, depth).alias("range")).agg(
            F.count(F.lit(1)).alias("n")
        )
        all_rows = F.sum("n").over(own)
        wanted = F.floor(all_rows * F.lit(share) + F.lit(0.5))
        if missing:
            wanted = _per_class(missing, F.col("label"), 0)
        reached = (
            counts.select("*", F.sum("n").over(up_to).alias("upto"), wanted.alias("wanted"))
            .where(F.col("upto") >= F.col("wanted"))
            .groupBy("label")
            .agg(F.min(F.struct("range", "upto", "n", "wanted")).alias("at"))
        )
        prefixes, missing = {}, {}
        for value, at in reached.collect():
            if not at["wanted"]:
                cuts[value] = None
            elif at["upto"] == at["wanted"] or depth == HASH_DIGITS:
                cuts[value] = at["range"]
            else:
                prefixes[value] = at["range"]
                missing[value] = at["wanted"] - (at["upto"] - at["n"])
        if not prefixes:
            break
        mine = F.col("hash").startswith(_per_class(prefixes, F.col("label"), "-"))
        rows = hashed.where(mine)
    return cuts


def is_test_row(cuts: dict, label: str, key: str, seed: int = SEED) -> Column:
    """True for the test rows under ``cuts``."""
    found = split_hash(key, seed)
    out = F.lit(False)
    for value, cut in cuts.items():
        if cut is not None:
            test = F.substring(found, 1, len(cut)) <= F.lit(cut)
            out = F.when(F.col(label).eqNullSafe(F.lit(value)), test).otherwise(out)
    return out


def with_split(
    df: DataFrame,
    label: str = "churned",
    key: str = "customer_id",
    share: float = TEST_SHARE,
    seed: int = SEED,
    name: str = "is_test",
) -> DataFrame:
    """``df`` with a flag of its test rows, as many of each class as ``share`` says."""
    return df.withColumn(name, is_test_row(class_cuts(df, label, key, share, seed), label, key, seed))


def stratified_split(
    df: DataFrame,
    label: str = "churned",
    key: str = "customer_id",
    share: float = TEST_SHARE,
    seed: int = SEED,
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows."""
    test = is_test_row(class_cuts(df, label, key, share, seed), label, key, seed)
    return df.where(~test), df.where(test)
