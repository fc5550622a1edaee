"""Repairs of extraction answers, case by case, and summaries and keywords by a model."""

from pyspark.sql import functions as F

from tessera.functions import text
from tessera.plans.summaries import keywords, summarise
from tessera.sources import files

#: One case, at least, of each damaged form.
CASES = (
    "a<|##|>b", "a<|\\#|>b", "a<|>b", "a<||>b", "a<X|#|Y>b", "a<#>b", "a<#|>b", "a<|#>b", "a<X#|>b", "a<|#X>b", "a<|#|b", "a<|#||b", "a<|#:b", "a<||#>b", "a<||b", "a|#|>b", "a<|#|>|b", "a||#||b", "a<|#|>b",
)


def test_each_damaged_delimiter_is_repaired(spark):
    rows = spark.createDataFrame([(c,) for c in CASES], "record string").select("record", text.repair_delimiters("record").alias("fixed")).collect()
    assert {r.record: r.fixed for r in rows} == dict.fromkeys(CASES, "a<|#|>b")


def test_names_are_normalised(spark):
    cases = {"“名 字”": "名字", "Ｔｅｓｔ（１２３）": "Test(123)", '"Bob"': "Bob", "12": "", "1.5": "", "1234567": "1234567", "<p>x</p>": "x", "中文 abc": "中文abc"}
    rows = spark.createDataFrame([(c,) for c in cases], "n string").select("n", text.normalize_name("n").alias("out")).collect()
    assert {r.n: r.out for r in rows} == cases


def test_summaries_in_rounds(spark):
    """Few and short lists are joined, others asked about in windows of tokens until one text is left."""
    rows = [("few", i, f"d{i}") for i in range(3)] + [("many", i, f"w{i} x") for i in range(20)] + [("long", 0, "y " * 60), ("none", 0, "")]
    df = spark.createDataFrame(rows, "k string, pos int, description string")
    got = {r.k: (r.description, r.asked) for r in summarise(df, "k", lambda groups: ["+".join(g) if len("+".join(g)) < 40 else f"s{len(g)}" for g in groups], few=8, short=50, window=12).collect()}
    assert got["few"] == ("d0<SEP>d1<SEP>d2", False)
    assert got["long"] == ("s1", True)
    assert got["many"][1] and "<SEP>" in got["many"][0] and set(got) == {"few", "many", "long"}


def test_keywords_come_from_the_cache_once_they_are_known(spark):
    q = spark.createDataFrame([(0, "mix", "who"), (1, "mix", "who"), (2, "local", "what")], "pos int, mode string, prompt string")
    none = spark.createDataFrame([], "key string, `return` string, cache_type string, original_prompt string, create_time long, update_time long")
    model = lambda prompts: [f'{{"high_level_keywords": ["{p}"], "low_level_keywords": []}}' for p in prompts]
    found, kept = keywords(q, none, model)
    assert sorted((r.pos, r.high_level_keywords, r.hit) for r in found.collect()) == [(0, ["who"], False), (1, ["who"], False), (2, ["what"], False)]
    again, _ = keywords(q, kept, lambda prompts: ["no json"] * len(prompts))
    assert all(r.hit and r.high_level_keywords for r in again.collect()) and kept.count() == 2


def test_graphml_round_trip(spark, tmp_path):
    nodes = spark.createDataFrame([("a & b", "x<y", None), ("c", "z", 3)], "id string, name string, size int").repartition(2)
    edges = spark.createDataFrame([("a & b", "c", 2.5)], "src string, tgt string, weight double")
    files.write_graphml(nodes, edges, str(tmp_path / "g"))
    n, e = files.read_graphml(spark, str(tmp_path / "g"))
    assert {(r.id, tuple(sorted(r.properties.items()))) for r in n.collect()} == {("a & b", (("name", "x<y"),)), ("c", (("name", "z"), ("size", "3")))}
    assert [(r.src, r.tgt, r.properties) for r in e.select("src", "tgt", F.col("properties")).collect()] == [("a & b", "c", {"weight": "2.5"})]


def test_years_of_five_digits(spark):
    row = spark.sql("select 777599913600 as s, timestamp_seconds(777599913600) as t, timestamp'0099-03-04 05:06:07' as old").select(text.epoch_text("s").alias("s"), text.iso_text("t").alias("t"), text.iso_text("old").alias("old")).first()
    assert tuple(row) == ("26611-03-01 00:00:00", "26611-03-01T00:00:00+00:00", "0099-03-04T05:06:07+00:00")


def test_plain_texts_skip_no_repair(spark):
    """Names and records that skip steps come out as by all steps, and filters do not repair again."""
    import random
    import re

    from tessera.operators import chunking

    rnd = random.Random(5)
    parts = ["<|#|>", "<", ">", "|", "#", "\\", ":", "a", " ", "<|#|>", "||#||", "<#>"]
    records = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 9))) for _ in range(3000)]

    def slow(c):
        for form in text.DAMAGED:
            c = F.regexp_replace(c, form.replace("{e}", re.escape("#")), "<|#|>")
        return c

    df = spark.createDataFrame([(r,) for r in records], "r string")
    assert df.where(~text.repair_delimiters("r").eqNullSafe(slow(F.col("r")))).count() == 0
    names = {"12": "", " 1.5 ": "", "123": "123", "1.2345": "1.2345", "....": "", "12 ": "", "1a": "1a", "": "", "plain name": "plain name", "\ta ": "a", "'x'": "x", "Ａ1": "A1"}
    got = spark.createDataFrame([(n,) for n in names], "n string").select("n", text.normalize_name("n", True).alias("out")).collect()
    assert {r.n: r.out for r in got} == names
    answers = spark.createDataFrame([("c", " entity<#>A<|#|>Thing, Other<|#|>about A\n\nrelation<|##|>A<|#|>B<|#|>k<|#|>d<|#|>2.5\nENTITY<|#|>B<|#|>x<|#|>y\nentityx<|#|>B<|#|>x<|#|>y\n<|COMPLETE|>\nentity<|#|>C<|#|>x<|#|>y")], "chunk_id string, answer string")
    for kind in (None, "entity"):
        found = chunking.entity_records(chunking.extraction_records(answers, kind=kind))
        assert sorted((r.pos, r.name, r.entity_type, r.description) for r in found.collect()) == [(0, "A", "thing", "about A"), (3, "B", "x", "y")]
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert not any("Filter" in line and "regexp_replace" in line for line in plan.splitlines())
    for kind in (None, "relation"):
        found = chunking.relation_records(chunking.extraction_records(answers, kind=kind)).collect()
        assert [(r.pos, r.src, r.tgt, r.keywords, r.weight) for r in found] == [(2, "A", "B", "k", 2.5)]


def test_graphml_files_are_whole_graphs_of_a_bounded_size(spark, tmp_path, monkeypatch):
    from xml.etree import ElementTree

    monkeypatch.setattr(files, "GRAPH_ROWS", 3, raising=False)
    for n in (0, 3, 7):
        at = tmp_path / f"g{n}"
        nodes = spark.range(n).selectExpr("concat('n', id) AS id").coalesce(1)
        files.write_graphml(nodes, nodes.selectExpr("id AS src", "concat(id, 'x') AS tgt"), str(at))
        sizes = sorted(len(ElementTree.parse(f).getroot()[0]) for f in (at / "edges").glob("part-*"))
        assert sum(sizes) == n and max(sizes, default=0) <= 3
        assert {r.src for r in files.read_graphml(spark, str(at))[1].collect()} == {f"n{i}" for i in range(n)}


def test_texts_without_entities_do_not_go_to_python(spark):
    rows = [(" a &amp; b ", "a & b"), (" plain\x01 ", "plain"), ("&#32;x&lt;y&#9;", "x<y"), (None, None), ("", ""), ("&", "&")]
    df = spark.createDataFrame(rows, "t string, wanted string").select(text.sanitize("t").alias("got"), "wanted")
    assert [r.got for r in df.collect()] == [r.wanted for r in df.collect()]
    sent = [x for x in df._jdf.queryExecution().optimizedPlan().toString().split("\n") if "EvalPython" in x]
    assert len(sent) == 1 and "contains" in sent[0].lower()
