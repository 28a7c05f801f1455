"""Unit fixtures of single operators: small inputs, stated outputs."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidelark.functions import classify as C
from tidelark.functions import estimate as E
from tidelark.functions import jsonx as X
from tidelark.functions import models as Z
from tidelark.functions import text as T
from tidelark.operators import analytics as A
from tidelark.operators import findings as Q
from tidelark.operators import freeze as P
from tidelark.operators import gates as R
from tidelark.operators import helpers as H
from tidelark.operators import relational as J
from tidelark.sources import readers as S
from tidelark.sources import writers as K


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def findings_of(spark, source, target, mapping=None):
    df = spark.createDataFrame([("s1", source, target)], "string_id string, source string, target string")
    return [(r["type"], r["severity"]) for r in Q.hard_findings(df, "source", "target", mapping).collect()]


def test_blank_target_is_one_error(spark):
    assert findings_of(spark, "源文本", "") == [("empty_translation", "critical")]
    assert findings_of(spark, " ", "") == [("empty_source_translation_soft", "warning")]


def test_extra_token_soft_only_with_surplus_one(spark):
    assert findings_of(spark, "Alpha ⟦PH_1⟧", "Alpha ⟦PH_1⟧ ⟦PH_1⟧ ⟦PH_1⟧") == [("token_mismatch", "critical")]
    assert findings_of(spark, "Alpha ⟦PH_1⟧", "Alpha ⟦PH_1⟧ ⟦PH_1⟧") == [("token_mismatch_soft", "warning")]


def test_report_splits_warnings(spark):
    rows = [("empty_source_translation_soft", "warning"), ("source_tag_unbalanced", "warning"), ("token_mismatch_soft", "warning")]
    out = {r["type"]: r["approved"] for r in Q.report(spark.createDataFrame(rows, "type string, severity string")).collect()}
    assert sum(out.values()) == 2 and not out["token_mismatch_soft"]


@pytest.mark.parametrize(
    ("target", "category", "base", "review", "hint", "rule", "term", "mapping", "expected"),
    [
        ("123456789", "label_generic_short", 8, 10, "", "compact_preferred", "", "optional", ("length_overflow", "major")),
        ("Рекомендуется", "badge_micro_2c", 0, 0, "", "dictionary_only", "", "manual_review_required", ("compact_mapping_missing", "critical")),
        ("Сила великого мудреца", "item_skill_name", 30, 40, "item_compact_noun", "compact_preferred", "Сила Сэн.", "approved_available", ("length_overflow", "major")),
        ("Нагр. Превью", "promo_short", 20, 30, "promo_compound_pack", "compact_preferred", "", "optional", ("promo_expansion_forbidden", "major")),
        ("5★ Ниндзя · Хинаты Хьюга", "slogan_long", 20, 40, "headline_nameplate", "compact_preferred", "", "optional", ("headline_budget_overflow", "major")),
        ("Топ", "badge_micro_2c", 0, 0, "", "dictionary_only", "Топ", "approved_available", None),
    ],
)
def test_length_policy(spark, target, category, base, review, hint, rule, term, mapping, expected):
    lit = F.lit
    p = C.length_policy(lit(category), lit(0), lit(0), lit(base), lit(review))
    got = one(spark, Q.length_finding(lit(target), lit("源"), p, lit(hint), lit(rule), lit(term), lit(mapping)).alias("f"))["f"]
    assert [(x["type"], x["severity"]) for x in got] == ([expected] if expected else [])


def test_ui_art_rows(spark):
    df = spark.createDataFrame([(1, "BTN_1", "十连"), (2, "BTN_2", "领取{0}奖励")], "seq long, string_id string, source_zh string")
    a, b = C.prepare_rows(df, "source_zh", "string_id", "seq").orderBy("seq").collect()
    assert (a["string_id"], b["string_id"]) == ("UIART_000001", "UIART_000002")
    assert (a["max_len_target"], b["max_len_target"], a["max_len_review_limit"], b["max_len_review_limit"]) == ("4", "12", "5", "13")
    assert (a["ui_art_category"], b["ui_art_category"], a["ui_art_compact_term"], a["translation_mode"]) == ("label_generic_short", "title_name_short", "x10", "llm")


def test_categories_and_hints(spark):
    rows = ["荐", "极品", "商店", "巅峰列传", "首充礼包", "元素之力", "击破气球获得幸运值，累满幸运必得大奖"]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(rows)], "i int, s string").withColumn("c", C.ui_art_category(F.col("s")))
    out = df.withColumn("h", C.ui_art_hint(F.col("s"), F.col("c"))).orderBy("i").collect()
    assert [r["c"] for r in out] == ["badge_micro_1c", "badge_micro_2c", "label_generic_short", "title_name_short", "promo_short", "item_skill_name", "slogan_long"]
    assert [r["h"] for r in out] == ["", "badge_exact_map", "", "", "promo_compound_pack", "item_compact_noun", "headline_singleline"]


def test_largest_remainder_fills_the_total():
    assert sum(J.largest_remainder({"ui": 2, "dialogue": 2, "system": 1, "placeholder": 1}, 5).values()) == 5
    assert J.largest_remainder({}, 5) == {}


def test_validation_score(spark):
    assert one(spark, A.validation_score(*map(F.lit, (0.1, 0.2, 0.3, 0.4))).alias("s"))["s"] == pytest.approx(80.0)


def test_top_task_per_row(spark):
    rows = [(1, "length", "minor", 0), (1, "placeholder", "major", 1)]
    df = spark.createDataFrame(rows, "id int, type string, severity string, seq int")
    rank = F.when(F.col("severity") == "major", 1).otherwise(0)
    assert H.top_n(df, ["id"], [F.desc(rank), F.col("seq")]).first()["type"] == "placeholder"


def test_usage_precedence(spark):
    df = spark.createDataFrame([(100, 40, None, None), (None, None, 40, 20), (None, None, None, None)], "p long, c long, a long, b long")
    none = F.lit(None).cast("struct<prompt_tokens:bigint,completion_tokens:bigint>")
    got = [tuple(r["u"]) for r in df.select(E.usage(none, F.col("p"), F.col("c"), F.col("a"), F.col("b")).alias("u")).collect()]
    assert got == [(100, 40, False), (10, 5, True), (0, 0, False)]


def test_punctuation_is_ordered(spark):
    assert one(spark, T.sanitize_punctuation(F.lit("Loading..."), [("...", "…")]).alias("x"))["x"] == "Loading…"
    assert one(spark, T.sanitize_punctuation(F.lit("【系统】提示"), [("【", "«"), ("】", "»")]).alias("x"))["x"] == "«系统»提示"


def test_freeze_numbers_run_over_the_table_and_restore(spark):
    rows = [(1, "<color=#ffffff>选择一条</color> {0}"), (2, "{0} 和 {1} <color={1}>x</color>"), (3, ""), (4, None)]
    frozen, mapping = P.freeze(spark.createDataFrame(rows, "seq int, s string"), "s", "seq")
    got = {r["seq"]: r["tokenized"] for r in frozen.collect()}
    tokens = {r["original"]: r["token"] for r in mapping.collect()}
    assert tokens == {"<color=#ffffff>": "TAG_1", "</color>": "TAG_2", "<color={1}>": "TAG_3", "{0}": "PH_1", "{1}": "PH_2"}
    assert got[2] == "⟦PH_1⟧ 和 ⟦PH_2⟧ ⟦TAG_3⟧x⟦TAG_2⟧" and got[3] == "" and got[4] == ""
    m = F.create_map(*[F.lit(x) for o, t in tokens.items() for x in (t, o)])
    back = {r["seq"]: r["b"] for r in frozen.select("seq", T.restore_tokens(F.col("tokenized"), m).alias("b")).collect()}
    assert back[1] == rows[0][1] and back[2] == rows[1][1]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.sampled_from("abc"), max_size=6), st.lists(st.sampled_from("abc"), max_size=6))
def test_multiset_difference(spark, a, b):
    from collections import Counter

    df = spark.createDataFrame([(a, b)], "a array<string>, b array<string>")
    assert df.select(H.multiset_diff(F.col("a"), F.col("b")).alias("d")).first()["d"] == dict(Counter(a) - Counter(b))


def test_packing_keeps_both_limits(spark):
    rows = [("k", i, t) for i, t in enumerate([5, 5, 5, 20, 1, 1, 1, 1])]
    out = H.ordered_pack(spark.createDataFrame(rows, "k string, seq int, tokens int"), "k", "seq", "tokens", 3, 12).orderBy("seq").collect()
    assert [r["batch"] for r in out] == [0, 0, 1, 2, 3, 3, 3, 4]


def test_containment_join_by_first_letters_agrees(spark, monkeypatch):
    rows = spark.createDataFrame([(1, "abcde"), (2, "xyz"), (3, "")], "i int, t string")
    terms = spark.createDataFrame([("bc",), ("cde",), ("yz",)], "term string")
    wide = {(r["i"], r["term"]) for r in H.contains_join(rows, terms, "t", "term").collect()}
    monkeypatch.setattr(H, "BROADCAST_BYTES", 0)
    assert wide == {(r["i"], r["term"]) for r in H.contains_join(rows, terms, "t", "term").collect()} == {(1, "bc"), (1, "cde"), (2, "yz")}


def test_json_ladder(spark):
    texts = ['[{"id":"a","text":"b"}]', '<thinking>[1]</thinking>{"items":[{"id":"a","text":"b"}]}', '```json\n[{"id":"a","text":"b",}]\n```', 'x [{"id":"a","text":"b"} {"id":"c","text":"d"}] y', "no", ""]
    out = [r["p"] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(X.parse_items(F.col("t")).alias("p")).collect()]
    assert [len(p["items"]) for p in out] == [1, 1, 1, 2, 0, 0]
    assert [p["code"] for p in out] == ["ok"] * 4 + ["parse_error", "empty"]


def test_translate_splits_failing_batches(spark):
    def model(batch):
        if any(t == "bad" for _, t in batch):
            raise ValueError
        return [(i, t.upper()) for i, t in batch if t != "lost"]

    rows = [("1", "a"), ("2", "bad"), ("3", ""), ("4", "lost"), ("5", None)]
    out = {r["k"]: r["status"] for r in Z.translate(spark.createDataFrame(rows, "k string, t string"), "k", "t", model, batch=3).collect()}
    assert out == {"1": "ok", "2": "failed", "3": "skipped_empty", "4": "missing", "5": "skipped_empty"}


def test_glossary_metadata_and_locale(spark):
    doc = {"meta": {"scope": "ip", "language_pair": "zh-ru"}, "entries": [{"term_zh": "活动", "term_ru": "Событие"}, {"term_zh": "奖励", "targets": {"en-US": "Rewards"}, "scope": "base"}]}
    df = spark.createDataFrame(S.glossary_rows({"a.yaml": doc}), S.GLOSSARY).withColumn("seq", F.monotonically_increasing_id())
    assert {(r["term_zh"], r["scope"], r["source_file"]) for r in df.collect()} == {("活动", "ip", "a.yaml"), ("奖励", "base", "a.yaml")}
    assert [(r["term"], r["target"]) for r in S.resolved_targets(df, "en-US", "seq").collect()] == [("奖励", "Rewards")]


def test_csv_and_jsonl_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", 'x "y"\nz', ["t"]), ("b", "", [])], "string_id string, source_zh string, tags array<string>")
    K.write_csv(df, str(tmp_path / "c"))
    back = {r["string_id"]: (r["source_zh"], r["tags"]) for r in S.read_csv(spark, str(tmp_path / "c")).collect()}
    assert back == {"a": ('x "y"\nz', '["t"]'), "b": ("", "[]")}
    (tmp_path / "l.jsonl").write_text('{"type":"llm_call","n":1}\nbroken\n{"type":"other","n":2}\n')
    assert S.read_trace(spark, str(tmp_path / "l.jsonl"), "type string, n int").count() == 1


def test_encodings():
    assert S.detect_encoding("游戏文本。".encode("gb18030")) == "gb18030" and S.detect_encoding("﻿a".encode()) == "utf-8-sig"
    with pytest.raises(ValueError):
        S.detect_encoding(b"\xff\xff\xff", ("utf-8",))


def test_promotion_needs_its_gates(spark, tmp_path):
    path = str(tmp_path / "out")
    gate = spark.createDataFrame([(True,), (False,)], "passed boolean")
    assert not K.promote(spark.range(3), path, gate)
    assert K.promote(spark.range(3), path, gate.filter("passed")) and spark.read.parquet(path).count() == 3


def test_listing_rejects_unknown_values(spark):
    with pytest.raises(ValueError):
        R.listing(spark.range(3), {"id": 9}, [F.col("id")], 2, {"id": [1, 2]})


def test_stream_equals_batch(spark, tmp_path):
    from tidelark.streaming import state

    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("event_type", "user_id")
    events.write.parquet(str(tmp_path / "in"))
    seen = state.read_log(spark, str(tmp_path / "in"), "event_type string, user_id long", "parquet")
    state.resume(seen, str(tmp_path / "done"), lambda df: df, "user_id", str(tmp_path / "cp"))
    state.resume(seen, str(tmp_path / "done"), lambda df: df, "user_id", str(tmp_path / "cp"))
    assert spark.read.parquet(str(tmp_path / "done")).count() == events.select("user_id").distinct().count()


def test_delivery_keeps_every_row(spark):
    from tidelark.plans.localization import deliver

    def echo(batch):
        return [(i, t.replace("攻击", "attack ").replace("点", "")) for i, t in batch]

    rows = [("a", 1, "攻击{0}点"), ("b", 2, ""), ("c", 3, "<b>x</b>")]
    out = deliver(spark.createDataFrame(rows, "string_id string, seq int, source_zh string"), model=echo)
    got = {r["string_id"]: r["rehydrated_text"] for r in out["delivered"].collect()}
    assert got == {"a": "attack {0}", "b": "", "c": "<b>x</b>"}
    assert out["offenders"].count() == 0 and out["lost"].count() == 0


def test_numbers_without_a_global_window(spark):
    """Places in a total order, in all and within keys of which one has most rows; empty tables."""
    from tidelark.functions.order import numbered, numbered_within

    rows = [(i * 7919 % 1000, None if i % 50 == 0 else "big" if i % 10 else f"k{i % 3}") for i in range(1000)]
    df = spark.createDataFrame(rows, "v int, k string").repartition(5)
    got = sorted((r["number"], r["v"]) for r in numbered(df, ["v"]).collect())
    assert got == [(i + 1, i) for i in range(1000)]
    within = {(r["k"], r["v"]): r["n"] for r in numbered_within(df, ["k"], [F.desc("v")], "n").collect()}
    for key in {k for _, k in rows}:
        assert [within[key, v] for v in sorted((v for v, k in rows if k == key), reverse=True)] == list(range(1, sum(k == key for _, k in rows) + 1))
    assert numbered(df.limit(0), ["v"]).count() == 0 and numbered_within(df.limit(0), ["k"], ["v"]).count() == 0


def test_csv_in_other_charsets(spark, tmp_path):
    from tidelark.sources.readers import read_csv

    (tmp_path / "a.csv").write_bytes('id,text\n1,"荐\n极品"\n2,\n'.encode("gb18030"))
    got = sorted(map(tuple, read_csv(spark, str(tmp_path / "a.csv"), encoding="auto").collect()))
    assert got == [("1", "荐\n极品"), ("2", "")]


def test_a_broken_off_promotion_is_undone(spark, tmp_path):
    from tidelark.sources import writers

    path, passed = str(tmp_path / "t"), spark.createDataFrame([(True,)], "passed boolean")
    assert writers.promote(spark.range(3), path, passed)
    (tmp_path / "t").rename(tmp_path / "t_previous")  # as if it broke off between the two renames
    assert writers.recovered(spark, path) and spark.read.parquet(path).count() == 3
    assert writers.promote(spark.range(5), path, passed) and spark.read.parquet(path).count() == 5 and not (tmp_path / "t_previous").exists()


def test_empty_terms_are_in_no_text(spark, monkeypatch):
    from tidelark.operators import helpers

    rows, terms = spark.createDataFrame([("ab",), ("cd",)], "x string"), spark.createDataFrame([("",), ("a",), (None,)], "t string")
    for size in (1 << 25, 0):
        monkeypatch.setattr(helpers, "BROADCAST_BYTES", size)
        assert sorted(map(tuple, helpers.contains_join(rows, terms, "x", "t").collect())) == [("ab", "a")]
