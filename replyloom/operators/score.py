"""The one extension point: scoring requests with a model function."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from replyloom.domain import INTENTS, REPLY_SCHEMA

# a scorer maps a batch of texts to reply texts
Scorer = Callable[[pd.Series], pd.Series]


def constant_scorer(label: str = INTENTS[0]) -> Callable[[], Scorer]:
    return lambda: lambda texts: pd.Series(label, index=texts.index)


def keyword_scorer(rules: dict[str, str], default: str = INTENTS[0]) -> Callable[[], Scorer]:
    """The first rule whose pattern occurs in the text names the class."""

    def make() -> Scorer:
        def score(texts: pd.Series) -> pd.Series:
            out = pd.Series(default, index=texts.index)
            open_ = pd.Series(True, index=texts.index)
            for label, pattern in rules.items():
                hit = open_ & texts.str.contains(pattern, case=False, regex=True, na=False)
                out[hit] = label
                open_ &= ~hit
            return out

        return score

    return make


def score_requests(
    requests: DataFrame,
    make_scorer: Callable[[], Scorer],
    *,
    run_id: str,
    model: str,
    text: str = "user",
    tasks: int | None = None,
) -> DataFrame:
    """Replies of a pluggable scorer. ``make_scorer`` runs once per task and its
    result sees Arrow batches; ``tasks`` bounds how many run at a time, which is
    how a rate limit is kept."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = make_scorer()
        for batch in batches:
            start = time.perf_counter()
            raw = scorer(batch["text"])
            spent = (time.perf_counter() - start) * 1000 / max(len(batch), 1)
            yield pd.DataFrame(
                {
                    "request_id": batch["request_id"],
                    "run_id": run_id,
                    "model": model,
                    "stage": "plain",
                    "call_no": 1,
                    "raw": raw,
                    "latency_ms": spent,
                    "input_tokens": batch["text"].str.split().str.len().fillna(0).astype("int64"),
                    "output_tokens": 1,
                }
            )

    src = requests.select("request_id", F.col(text).alias("text"))
    if tasks:
        src = src.repartition(tasks)
    return src.mapInPandas(run, REPLY_SCHEMA)
