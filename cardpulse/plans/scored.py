"""Scoring as one plan: requests, their features, a score, a decision, a message."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cardpulse.operators.scoring import decide, route_decisions, score
from cardpulse.operators.store import get_online_features
from cardpulse.schema import (
    ALERT_THRESHOLD,
    SCORING_TX_FEATURES,
    SCORING_USER_FEATURES,
    TRANSACTION_FEATURES,
    USER_FEATURES,
)


def scoring_features(requests: DataFrame, live_users: DataFrame, live_tx: DataFrame) -> DataFrame:
    """The nine features of each scoring request (user_id, transaction_id)."""
    return get_online_features(requests, [
        (USER_FEATURES, live_users, SCORING_USER_FEATURES),
        (TRANSACTION_FEATURES, live_tx, SCORING_TX_FEATURES),
    ])


def decide_requests(
    requests: DataFrame, live_users: DataFrame, live_tx: DataFrame, model=None, threshold: float = ALERT_THRESHOLD
) -> DataFrame:
    return decide(score(scoring_features(requests, live_users, live_tx), model), threshold)


def alert_messages(decided: DataFrame) -> DataFrame:
    return route_decisions(decided)
