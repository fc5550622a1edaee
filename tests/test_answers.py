import json

import pytest
from test_engine import COLUMNS, embed, extract

from tessera.plans.answers import ask
from tessera.plans.engine import Engine
from tessera.plans.retrieval import QueryParam
from tessera.sources.tables import Store


@pytest.fixture(scope="module")
def engine(spark, tmp_path_factory):
    e = Engine(Store(spark, str(tmp_path_factory.mktemp("answers")), buckets=2), embed, extract, 8, 2)
    e.insert(spark.createDataFrame([(0, "Alice met Bob near the river", "a.txt"), (1, "Carol met Bob", "b.txt"), (2, "Dave sleeps", "d.txt")], COLUMNS))
    return e


class Asked(list):
    """A model that remembers its prompts."""

    def __init__(self, say):
        super().__init__()
        self.say = say

    def __call__(self, texts):
        self.extend(texts)
        return [self.say(t) for t in texts]


def prompt(question, frames, p):
    names = sorted(r.id for r in frames["entities"].collect()) if "entities" in frames else []
    return json.dumps([question, names, sorted(r.content for r in frames["chunks"].collect()), p.user_prompt])


def test_answers_are_kept_by_question_keywords_and_knobs(engine):
    model = Asked(lambda t: f"<think>hm</think>told {len(model)}")
    words = Asked(lambda q: 'Sure: {"high_level_keywords": ["near"], "low_level_keywords": ["Alice"]}')
    first = ask(engine, "Who met whom?", model, prompt, QueryParam(top_k=1), words)
    assert first.content == "told 1" and not first.kept and (first.high, first.low) == (("near",), ("Alice",))
    again = ask(engine, "Who met whom?", model, prompt, QueryParam(top_k=1), words)
    assert again.content == "told 1" and again.kept and len(model) == len(words) == 1
    for p in (QueryParam(top_k=2), QueryParam(top_k=1, user_prompt="short"), QueryParam(top_k=1, ll_keywords=("Carol",))):
        assert not ask(engine, "Who met whom?", model, prompt, p, words).kept
    assert len(model) == 4 and len(words) == 1
    kinds = [r.cache_type for r in engine.store.read("llm_response_cache").where("cache_type in ('query', 'keywords')").collect()]
    assert sorted(kinds) == ["keywords"] + ["query"] * 4


def test_keywords_choose_what_is_looked_up(engine):
    said = lambda **p: json.loads(ask(engine, "x", Asked(str), prompt, QueryParam(only_need_prompt=True, top_k=1, cosine_threshold=0.1, **p)).content)
    assert said(mode="local", ll_keywords=("Dave Dave appears",))[1] == ["Dave"]
    assert said(mode="local", ll_keywords=("Carol Carol appears",))[1] == ["Carol"]
    assert said(mode="global", hl_keywords=("near next Alice Bob Alice with Bob",))[1] == ["Alice", "Bob"]
    assert said(mode="hybrid", hl_keywords=("near next Alice Bob Alice with Bob",))[1] == ["Alice", "Bob"]  # no low-level ones
    # none found: a short question is one, a long one has no answer
    none = Asked(lambda q: "no idea")
    assert ask(engine, "Dave Dave appears", Asked(str), prompt, QueryParam(mode="local", top_k=1), none).low == ("Dave Dave appears",)
    assert ask(engine, "Dave appears " * 9, Asked(str), prompt, QueryParam(mode="local"), none).content is None


def test_models_of_a_query_and_modes_without_a_graph(engine):
    model, own = Asked(lambda t: "general"), Asked(lambda t: "own")
    assert ask(engine, "Alice met Bob", model, prompt, QueryParam(mode="naive", model=own)).content == "own" and not model
    assert ask(engine, "hello", model, prompt, QueryParam(mode="bypass")).content == "general" and model == ["hello"]
    assert ask(engine, " ", model, prompt).content is None
    assert ask(engine, "Alice met Bob", model, prompt, QueryParam(mode="naive", cosine_threshold=2.0)).content is None and len(model) == 1
    with pytest.raises(ValueError):
        ask(engine, "x", model, prompt, QueryParam(mode="other"))


def test_reranking_orders_and_cuts_chunks(engine):
    score = lambda q, texts: [None if "Carol" in t else 0.9 if "Alice" in t else 0.1 for t in texts]
    p = QueryParam(mode="naive", cosine_threshold=-1.0, rerank=score, min_rerank_score=0.5)
    rows = sorted(engine.query("met", p)["chunks"].collect(), key=lambda r: r.pos)
    assert [(r.id, r.content) for r in rows] == [("DC1", "Carol met Bob"), ("DC2", "Alice met Bob near the river")]
    assert [r.id for r in engine.query("met", QueryParam(mode="naive", cosine_threshold=-1.0, chunk_top_k=1))["chunks"].collect()] == ["DC1"]
