"""Self-training, the annotation queue and the validation set."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions.scalars import argmax_label, drop_unlabeled, max_prob
from marquee.operators.joins import apply_annotations
from marquee.operators.ranking import queue_position
from marquee.schemas import LABELED, PROBABILITIES, VALIDATION

THRESHOLD = 0.90


def self_train(scored: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Rows whose largest class probability reaches the threshold, labelled with that class."""
    sure = scored.filter(max_prob(*PROBABILITIES) >= threshold)
    return sure.withColumns(
        {"label": argmax_label(*PROBABILITIES), "method": F.lit("self-training")}
    )


def unsure(scored: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Rows whose largest class probability is below the threshold."""
    return scored.filter(max_prob(*PROBABILITIES) < threshold)


def annotation_queue(scored: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Rows to label by hand, with their 0-based place ``pos``."""
    return queue_position(unsure(scored, threshold)).withColumn("method", F.lit("manual-annotation"))


def label_by_hand(queue: DataFrame, annotations: DataFrame) -> DataFrame:
    """Answered rows of a published queue, ready for the labeled table.

    Answers name places of that very queue; it is read, never worked out anew, so later posts, models or thresholds
    can't move a label to another post.
    """
    return drop_unlabeled(apply_annotations(queue, annotations)).drop("pos")


def update_validation(
    current: DataFrame, posts: DataFrame, annotations: DataFrame, method: str = "update"
) -> DataFrame:
    """The validation set after a session over ``posts``: ``init`` replaces it, ``update`` adds to it."""
    if method not in ("init", "update"):
        raise ValueError("method must be 'init' or 'update'")
    answered = apply_annotations(queue_position(posts), annotations)
    rows = drop_unlabeled(answered).select(*VALIDATION.columns)
    return rows if method == "init" else current.select(*VALIDATION.columns).unionByName(rows)


def labeled_rows(*parts: DataFrame) -> DataFrame:
    """Parts in the column order of the labeled table, stacked."""
    return reduce(DataFrame.unionByName, (p.select(*LABELED.columns) for p in parts))
