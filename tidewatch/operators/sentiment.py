"""Headline sentiment on the executors.

``score_news`` is the built-in lexicon scorer as column expressions.
``score_news_with_model`` runs any scorer through an iterator Pandas UDF: the
factory is called once per task (load a model there), texts go in batches
of ``batch_size``, and each label must be one of positive / negative /
neutral. The whole text goes to the scorer; ``onnx_factory`` meets a
model's input limit by scoring consecutive windows and averaging them, so
no text is cut. No rows pass through the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.exprs import rnd
from tidewatch.functions.lexicon import (LABELS, NEGATIVE_WORDS, POSITIVE_WORDS, directional, lexicon_columns,
                                        lexicon_score_pandas)
from tidewatch.operators.silver import SCORED_NEWS_COLUMNS

Scorer = Callable[[list[str]], tuple[list[str], list[float]]]


def score_news(news: DataFrame, text: str = "title", positive: Sequence[str] = POSITIVE_WORDS,
               negative: Sequence[str] = NEGATIVE_WORDS) -> DataFrame:
    """Silver news with label, score and directional score (lexicon rule over the given word lists)."""
    scored = news.withColumns(lexicon_columns(text, positive, negative))
    return scored.withColumn("sentiment_directional", directional()).select(*SCORED_NEWS_COLUMNS)


def lexicon_factory() -> Scorer:
    """Default factory: the lexicon rule in pandas (same results as ``score_news``)."""
    return lexicon_score_pandas


# Windows that go through the model at once, whatever the texts' lengths.
WINDOWS_PER_RUN = 32


def _onnx_scorer(model_path: str, tokenizer_path: str, labels: tuple[str, ...], max_length: int) -> Scorer:
    """Build the scorer on the executor: one ONNX session and tokenizer per task.

    A text longer than the model's input length is split into consecutive
    windows of ``max_length`` tokens, each with the tokenizer's start and end
    tokens; the logits of all its windows are averaged, so the whole text is
    scored, not its first window. At most ``WINDOWS_PER_RUN`` windows are in
    memory as one model input. Label = argmax, score = softmax probability of
    that label.
    """
    import numpy as np
    import onnxruntime as ort
    from tokenizers import Tokenizer

    session = ort.InferenceSession(model_path, providers=["CPUExecutionProvider"])
    names = {i.name for i in session.get_inputs()}
    tok = Tokenizer.from_file(tokenizer_path)
    tok.no_padding()
    tok.enable_truncation(max_length)  # what is cut off comes as overflowing windows
    pad = tok.token_to_id("[PAD]") or 0

    def logits_of(windows: list[list[int]]):
        width = max(len(w) for w in windows)
        input_ids = np.full((len(windows), width), pad, dtype=np.int64)
        mask = np.zeros((len(windows), width), dtype=np.int64)
        for r, w in enumerate(windows):
            input_ids[r, : len(w)] = w
            mask[r, : len(w)] = 1
        feeds = {"input_ids": input_ids, "attention_mask": mask, "token_type_ids": np.zeros_like(input_ids)}
        return session.run(None, {k: v for k, v in feeds.items() if k in names})[0]

    def score(texts: list[str]) -> tuple[list[str], list[float]]:
        windows, owner = [], []
        for i, enc in enumerate(tok.encode_batch([t or "" for t in texts])):
            parts = [e.ids for e in (enc, *enc.overflowing)]
            windows += [ids or [pad] for ids in parts]
            owner += [i] * len(parts)
        sums = np.zeros((len(texts), len(labels)))
        for at in range(0, len(windows), WINDOWS_PER_RUN):
            np.add.at(sums, np.asarray(owner[at:at + WINDOWS_PER_RUN]), logits_of(windows[at:at + WINDOWS_PER_RUN]))
        mean = sums / np.bincount(owner, minlength=len(texts))[:, None]
        probs = np.exp(mean - mean.max(axis=1, keepdims=True))
        probs /= probs.sum(axis=1, keepdims=True)
        best = probs.argmax(axis=1)
        return [labels[k] for k in best], [float(probs[r, k]) for r, k in enumerate(best)]

    return score


def onnx_factory(model_path: str, tokenizer_path: str, labels: tuple[str, ...] = LABELS,
                 max_length: int = 512) -> Callable[[], Scorer]:
    """A scorer factory for an exported sequence classifier (ONNX + tokenizer JSON).

    ``labels`` names the model's output columns in order. The files must be
    readable on every executor (shared storage, or ``SparkContext.addFile``
    and ``SparkFiles.get``). Requires ``onnxruntime`` and ``tokenizers``.
    """
    from functools import partial

    return partial(_onnx_scorer, model_path, tokenizer_path, tuple(labels), max_length)


def score_news_with_model(news: DataFrame, factory: Callable[[], Scorer] = lexicon_factory,
                          batch_size: int = 32, text: str = "title") -> DataFrame:
    """Score ``text`` with a scorer built by ``factory`` on each task; only the text leaves the JVM."""

    @F.pandas_udf("label string, score double")
    def model(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = factory()
        for column in batches:
            labels: list[str] = []
            scores: list[float] = []
            texts = column.fillna("").tolist()
            for i in range(0, len(texts), batch_size):
                lab, sc = scorer(texts[i:i + batch_size])
                bad = set(lab) - set(LABELS)
                if bad:
                    raise ValueError(f"scorer returned unknown labels: {sorted(bad)}")
                labels.extend(lab)
                scores.extend(float(s) for s in sc)
            yield pd.DataFrame({"label": labels, "score": scores})

    scored = news.withColumn("_scored", model(text)).withColumns(
        {"sentiment_label": F.col("_scored.label"), "sentiment_score": rnd("_scored.score", 4)})
    return scored.withColumn("sentiment_directional", directional()).select(*SCORED_NEWS_COLUMNS)


def label_breakdown(scored: DataFrame) -> DataFrame:
    """Rows per sentiment label."""
    return scored.groupBy("sentiment_label").agg(F.count(F.lit(1)).alias("count"))
