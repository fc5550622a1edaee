"""One question, answered: keywords, what is known, the caller's prompt, the model's text; answers are kept in the cache."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import dataclass, field, replace

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import keyword_lists, without_thinking
from tessera.plans.engine import Engine
from tessera.plans.retrieval import MODES, QueryParam, retrieve
from tessera.sources.tables import SCHEMAS, Store

#: A question below this length is its own low-level keyword where no keywords are found; a longer one has no answer.
SHORT = 50

Model = Callable[[list[str]], list[str]]


@dataclass(frozen=True)
class Answer:
    """``content`` is None where nothing was found to answer from; ``kept`` tells that the model was not asked."""

    content: str | None
    kept: bool = False
    frames: dict[str, DataFrame] = field(default_factory=dict)
    high: tuple[str, ...] = ()
    low: tuple[str, ...] = ()


def ask(engine: Engine, question: str, model: Model, prompt: Callable[[str, dict[str, DataFrame], QueryParam], str], p: QueryParam = QueryParam(), keywords: Model | None = None, now: int = 0) -> Answer:
    """Answer a question in the mode of ``p``.

    Keywords are those of ``p``, or what ``keywords`` makes of the question (JSON, kept in the cache); relations are looked up
    by the high-level ones, entities by the low-level ones, chunks by the question; without a function for keywords the
    question stands for both.  ``prompt`` makes the model's text from the question, the frames and ``p``; frames are cut by
    the budgets of ``p``, so they may be collected.  An answer is kept under its mode, question, keywords and knobs, and is
    found again whatever the knowledge base holds by then, until the cache is cleared.  Bypass asks the model alone and
    keeps nothing; an empty question has no answer.
    """
    if p.mode not in MODES:
        raise ValueError(f"no such mode: {p.mode}")
    use = model if p.model is None else p.model
    if not question.strip():
        return Answer(None)
    if p.mode == "bypass":
        return Answer(_told(engine.store, use([question])[0]))
    low = high = None
    if p.mode != "naive" and (keywords is not None or p.hl_keywords or p.ll_keywords):
        p = p if p.hl_keywords or p.ll_keywords else _with_keywords(engine.store, question, p, keywords, now)
        if not p.hl_keywords and not p.ll_keywords:
            if len(question) >= SHORT:
                return Answer(None)
            p = replace(p, ll_keywords=(question,))
        high, low = (_vector(engine, ", ".join(k)) if k else [] for k in (p.hl_keywords, p.ll_keywords))
    frames = retrieve(engine.knowledge(), _vector(engine, question), p, low, high, question)
    if all(df.isEmpty() for name, df in frames.items() if name != "references"):
        return Answer(None, False, frames, p.hl_keywords, p.ll_keywords)
    text = prompt(question, frames, p)
    if p.only_need_prompt:
        return Answer(text, False, frames, p.hl_keywords, p.ll_keywords)
    knobs = {
        "mode": p.mode, "response_type": p.response_type, "top_k": p.top_k, "chunk_top_k": p.chunk_top_k, "max_entity_tokens": p.max_entity_tokens, "max_relation_tokens": p.max_relation_tokens,
        "max_total_tokens": p.max_total_tokens, "hl_keywords": ", ".join(p.hl_keywords), "ll_keywords": ", ".join(p.ll_keywords), "user_prompt": p.user_prompt, "enable_rerank": p.rerank is not None,
    }
    key = _key(p.mode, "query", question, *knobs.values())
    content = _kept(engine.store, key)
    kept = content is not None
    if not kept:
        content = _told(engine.store, use([text])[0])
        _keep(engine.store, key, "query", content, question, knobs, now)
    return Answer(content, kept, frames, p.hl_keywords, p.ll_keywords)


def _vector(engine: Engine, text: str) -> list[float]:
    return list(map(float, np.asarray(engine.embed([text]))[0]))


def _told(store: Store, text: str) -> str:
    """A model's text without its thinking."""
    return store.spark.createDataFrame([(text,)], "t string").select(without_thinking("t").alias("t")).first()["t"] or ""


def _with_keywords(store: Store, question: str, p: QueryParam, keywords: Model, now: int) -> QueryParam:
    key = _key(p.mode, "keywords", p.mode, question)
    text = _kept(store, key)
    if text is None:
        text = _told(store, keywords([question])[0])
        _keep(store, key, "keywords", text, question, {}, now)
    found = store.spark.createDataFrame([(text,)], "t string").select(keyword_lists("t").alias("k")).select("k.*").first()
    some = lambda words: tuple(w.strip() for w in words or () if w and w.strip())
    return replace(p, hl_keywords=some(found["high_level_keywords"]), ll_keywords=some(found["low_level_keywords"]))


def _key(mode: str, kind: str, *parts: object) -> str:
    # parts are parted, so that what ends one never begins the next
    return f"{mode}:{kind}:{hashlib.md5(json.dumps([str(x) for x in parts]).encode()).hexdigest()}"


def _kept(store: Store, key: str) -> str | None:
    row = store.read("llm_response_cache").where(F.col("id") == key).select("return").first()
    return None if row is None else row["return"]


def _keep(store: Store, key: str, kind: str, text: str, question: str, knobs: dict, now: int) -> None:
    """Put one answer into the cache; an empty one is not kept."""
    if text:
        row = (key, text, kind, None, question, json.dumps(knobs), now, now)
        store.change("llm_response_cache", store.spark.createDataFrame([row], SCHEMAS["llm_response_cache"]))
