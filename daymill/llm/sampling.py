"""Bounded, deterministic samples of labelled rows to fit classifiers on."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LABELLED_ROWS = 200_000  # labelled rows that a classifier looks at, about

def labelled_sample(rows: DataFrame, label: str, per_class: int, key: str = "text") -> DataFrame:
    """About `per_class` rows of each class at most, all of a smaller one, chosen by a hash of `key`: equal keys are
    chosen alike, and a rerun chooses the same.

    A class's share is its bound over its number of rows, which is counted over all of them; one number per class
    reaches the driver. No row is shuffled for it.
    """
    counts = rows.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()
    share = F.lit(0.0)
    for row in counts:
        share = F.when(F.col(label) == F.lit(row[label]), F.lit(per_class / row.n)).otherwise(share)
    place = F.pmod(F.xxhash64(F.lit("sample"), key), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return rows.filter(place < share)


def with_labels(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", bound: int = LABELLED_ROWS) -> DataFrame:
    """`docs` joined with their labels: all of them, or about `bound`, chosen by a hash of the id, so that every class
    keeps its rate. Ids are chosen before any text is touched; they are broadcast, being bounded, and no text is shuffled."""
    share = bound / max(1, labels.count())
    place = F.pmod(F.xxhash64(F.lit("labelled"), id_col), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return docs.join(F.broadcast(labels.filter(place < share)), id_col)


def once(rows: DataFrame, columns: list[str], at: str = "at") -> DataFrame:
    """Rows of which equal ones in `columns` are one: the one with the smallest number `at`. Digests and numbers are
    shuffled, never the columns themselves; the numbers of those that stay are broadcast while there are few."""
    digest = F.sha2(F.to_json(F.struct(*columns)), 256)
    chosen = rows.groupBy(digest.alias("digest")).agg(F.min(at).alias(at)).select(at)
    if rows.count() <= 5 * LABELLED_ROWS:
        chosen = F.broadcast(chosen)
    return rows.join(chosen, at, "left_semi")
