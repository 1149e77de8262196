"""Steps whose cost must not outgrow the input, and their results."""

import re
import weakref

import duckdb
import pyarrow as pa
from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.operators import gates, glossary, html, lines, locale_format
from tessera.plans import queries, relational

DATA = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_hits_do_not_shuffle_texts_by_word(spark):
    units = spark.range(100).select(F.col("id").alias("hash"), F.lit("for an Acme, the acme").alias("text"))
    terms = spark.createDataFrame([("Acme", "keep", None, True, None), ("an acme", "keep", None, False, None), ("acm", "keep", None, False, None)], glossary.SCHEMA)
    found = glossary.hits(units, terms)
    assert "SortMergeJoin" not in plan(found) and "Exchange hashpartitioning" not in plan(found)
    assert {(r[0], r[1]) for r in found.groupBy("source").count().collect()} == {("Acme", 100), ("an acme", 100)}


def test_terms_for_batch_exchanges_units_once(spark):
    found = plan(queries.QUERIES["terms_for_batch"](spark, DATA))
    assert "SortMergeJoin" not in found and "hashpartitioning(__word" not in found


def test_terms_are_found_before_units_are_merged(spark):
    """Units and words that repeat give one row; texts go to no exchange or sort."""
    units = spark.createDataFrame([("h1", "for the Acme, for all")] * 3 + [("h2", "Acme"), ("h3", "none"), ("h4", None)], "hash string, text string")
    terms = spark.createDataFrame([("Acme", "keep", None, True, None), ("for", "keep", None, False, None)], glossary.SCHEMA)
    assert sorted(map(tuple, glossary.hits_of_units(units, terms).collect())) == [("h1", "Acme"), ("h1", "for"), ("h2", "Acme")]
    memory = spark.createDataFrame([("xx", "h1"), ("yy", "h1"), ("xx", "h2")], "lang string, hash string")
    assert [tuple(r) for r in glossary.invalidate(memory, units, terms.filter("source = 'for'")).collect()] == [("h2", "xx")]
    for name in ("terms_for_batch", "glossary_hits", "tm_invalidate"):
        found = plan(queries.QUERIES[name](spark, DATA))
        assert "min(text" not in found and "SortAggregate" not in found and "first_seen" not in found


def test_offered_searches_only_shared_strings(spark, monkeypatch):
    """Odd strings against the joined text, and no joined text where no string can span units."""
    words = ["alpha beta", "lpha bet", "abc", "bcd", "ein längerer gemeinsamer Satz", "Satz 😀 mit Zeichen", "beta  gamma", "zzz zzz", "one  two"]
    units = [("a", "xalpha betax"), ("a", "zabcz"), ("a", "<1>ein längerer</1> gemeinsamer Satz"), ("a", "vor Satz 😀 mit Zeichen nach"), ("a", "has one  two inside"), ("b", "alpha beta"), ("b", "alpha beta"), ("b", "ein längerer gemeinsamer Satz")]
    pairs = [(s, w) for s in "abc" for w in words]
    source = spark.createDataFrame([p for p in pairs if p != ("a", "lpha bet")], "slug string, text string")
    seen = spark.createDataFrame([(s, lang, w) for s, w in pairs for lang in ("de", "de", "fr")] + [(None, "de", "abc"), ("a", "es", "only here")], "slug string, lang string, text string")
    extracted = spark.createDataFrame(units, "slug string, text string")
    monkeypatch.setattr(gates, "A_PASS", 2)
    whole = {s: "  ".join(re.sub("</?[0-9]+/?>", " ", t) for u, t in units if u == s) for s in "abc"}
    holes = {(s, w) for s, w in pairs if (s, w) != ("a", "lpha bet") and w not in whole[s]}
    assert {tuple(r) for r in gates.never_offered(source, seen, extracted).collect()} == {(s, lang, w) for s, w in holes for lang in ("de", "fr")}
    rates = {r["lang"]: (r["holes"], r["kept"], r["total"]) for r in gates.hole_rate(source, seen, extracted).collect()}
    kept = len(pairs) - 1 - len(holes)
    assert rates == {"de": (2 * len(holes), 2 * kept, 2 * len(pairs) + 1), "fr": (len(holes), kept, len(pairs)), "es": (0, 0, 1)}


def test_hole_rate_makes_no_joined_text(spark):
    assert "collect_list" not in plan(queries.QUERIES["hole_rate"](spark, DATA))


def test_page_titles_equal_sql_on_odd_titles(spark, tmp_path):
    made = ["the&&&amp", "A &amp;amp; b &middot; &copy", "FAQ", "English", "&amp;middot; x", "   Wide 　", "\tTab\n", "12 %", "", "mailto:a", "&lt;b&gt;", "a</title><title>b"]
    odd = ["<TITLE>Upper</TITLE>", "<title lang='x'>With</title>", "<svg><title>One</title></svg><title>Two</title>", "<!-- <title>Kept</title> --><title>Not</title>", "no title", None]
    html_ = [f"<html><head><title>{t}</title></head><body><p>Text</p></body></html>" for t in made] + odd
    spark.createDataFrame(list(enumerate(html_)), "page_id long, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    duck = duckdb.connect()
    duck.sql(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    theirs = sorted(duck.sql(queries.ORACLES["page_titles"]).fetchall())
    assert sorted((r["page_id"], r["title"]) for r in queries.QUERIES["page_titles"](spark, str(tmp_path)).collect()) == theirs


class Pages:
    """Stands for a table of pages; gives the function that Spark would run over batches."""

    def select(self, *names):
        return self

    def mapInArrow(self, run, schema):
        return run


def one_batch():
    sources = [f"<html><body><p title='Word {i}'>Text of page {i}</p><p>More text {i}</p></body></html>" for i in range(50)] + [None, ""]
    return pa.RecordBatch.from_pydict({"page": list(range(len(sources))), "html": sources})


def test_html_segments_leave_in_slices(monkeypatch):
    monkeypatch.setattr(html, "A_SLICE", 300)
    out = list(html.extract(Pages())(iter([one_batch()])))
    rows = [r for b in out for r in b.to_pylist()]
    assert len(out) > 10 and max(b.num_rows for b in out) <= 16
    assert [(r["page"], r["seg"]) for r in rows] == [(p, s) for p in range(50) for s in range(3)]


def test_html_facts_leave_in_slices(monkeypatch):
    monkeypatch.setattr(html, "A_SLICE", 300)
    out = list(html.facts(Pages())(iter([one_batch()])))
    rows = [r for b in out for r in b.to_pylist()]
    assert len(out) > 10 and max(b.num_rows for b in out) <= 6
    assert len(rows) == 52 and rows[0]["tags"] == ["html", "body", "p", "p"] and rows[51]["visible"] == []


def test_batches_of_pages_are_let_go_before_the_next(spark):
    """Also a page whose pieces lie in two batches."""
    held = []

    def batches():
        for k in range(3):
            assert not any(b() is not None for b in held)
            batch = pa.RecordBatch.from_pydict({"page": [k, k, k + 1], "pos": [1 if k else 0, 2 if k else 1, 0], "html": ["<p>", "<b>x</b>", "<i>"]})
            held.append(weakref.ref(batch))
            yield batch
            del batch

    rows = [r for b in html.facts(Pages())(batches()) for r in b.to_pylist()]
    assert [(r["page"], r["tags"]) for r in rows] == [(0, ["p", "b"]), (1, ["i", "p", "b"]), (2, ["i", "p", "b"]), (3, ["i"])]


def test_pages_travel_in_pieces(spark, monkeypatch):
    """No row that goes to Python is longer than a piece; the rows that come back are those of whole pages."""
    sources = ["<p title='Ein Titel'>Grüße 😀😀 an\nalle &amp; mehr</p>" * 30, None, "", "<p>One</p>", "<p>One</p>", "\r\n<b>x</b>\u2028 <i>Text here</i>" * 7]
    pages = spark.createDataFrame([(i // 2, s) for i, s in enumerate(sources)], "page long, html string").coalesce(1)
    whole = [(i // 2, html.Builder(s or "").tags) for i, s in enumerate(sources)]
    longest = max(len(s) for s in sources if s)
    monkeypatch.setattr(html, "A_PIECE", longest)
    once = [tuple(r) for r in html.extract(pages).collect()]
    for piece in (1, 7, 400):
        monkeypatch.setattr(html, "A_PIECE", piece)
        assert html._pieces(pages).agg(F.max(F.length("html"))).first()[0] == min(piece, longest)
        assert [(r["page"], r["tags"]) for r in html.facts(pages).collect()] == whole
        assert [tuple(r) for r in html.extract(pages).collect()] == once
    assert "Generate posexplode" in plan(queries.QUERIES["tag_sequence"](spark, DATA))


def test_texts_alone_equal_the_full_report(spark):
    """Many rows, nulls, unknown locales, and more digits than the decimal module's default precision."""
    texts = ["Total $1,234.50 (12.5% of 1,234)", None, "", "none", "$" + "9" * 40, "007% 00,5%", "5 JPY and <1>1,500</1>", "US$12 a 1.2.3"]
    rows = spark.createDataFrame([(t, n) for t in texts for n in ("de", "fr", None, "zz")], "t string, l string")
    told = locale_format.format_text(rows, "t", "l", locales=["de", "fr"]).select("t", "l", "formatted.text")
    alone = locale_format.format_text(rows, "t", "l", locales=["de", "fr"], report=False)
    assert alone.schema["formatted"].dataType.names == ["text"]
    got = [tuple(r) for r in alone.select("t", "l", "formatted.text").collect()]
    assert got == [tuple(r) for r in told.collect()] and got[0][2].startswith("Total 1.234,50")


def test_format_text_sends_texts_alone(spark):
    found = plan(queries.QUERIES["format_text"](spark, DATA))
    assert "changes" not in found and "money" not in found
    assert queries.QUERIES["format_text"](spark, DATA).filter("locale = 'de' AND text LIKE 'Total %,__ $ (12,5 % of 1.234)'").count() == queries.table(spark, DATA, "orders").count()


def test_violations_between_equal_those_of_pairs(spark):
    """With keys that repeat and turns without an answer; no source text goes to the join."""
    turns = [(1, 0, "Acme for all"), (1, 1, "Acme"), (1, 1, "nothing"), (1, 2, "for the acme"), (2, 0, "for"), (3, 0, None), (3, 1, "x")]
    talks = spark.createDataFrame(turns, "conv_id long, turn long, text string")
    terms = spark.createDataFrame([("Acme", "keep", None, True, None), ("for", "translate", {"xx": "Nothing"}, False, None), ("all", "translate", None, True, None)], glossary.SCHEMA)
    split = glossary.violations_between(lines.sources(talks), lines.targets(talks), ["conv_id", "turn"], terms, "xx")
    whole = glossary.violations(lines.pairs(talks), terms, "xx").select("conv_id", "turn", "source")
    assert sorted(map(tuple, split.select("conv_id", "turn", "source").collect())) == sorted(map(tuple, whole.collect())) == [(1, 0, "Acme"), (1, 0, "for"), (1, 1, "Acme")]


def test_glossary_violations_join_found_terms(spark):
    found = plan(queries.QUERIES["glossary_violations"](spark, DATA))
    assert "__word" not in "".join(x for x in found.splitlines() if "Exchange hashpartitioning" in x) and "SortMergeJoin [__word" not in found


def test_gate_summary_moves_no_turns_and_no_joined_units(spark, tmp_path):
    """Drift joins numbers, not texts; no joined text of units, no join by word."""
    turns = [(1, 0, "5 apples"), (1, 1, "6 and 5"), (2, 0, "1,000"), (2, 1, "it is 1000"), (3, 0, "none"), (3, 1, "7"), (4, 0, None), (4, 1, "7")]
    spark.createDataFrame(turns, "conv_id long, turn long, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    assert {tuple(r) for r in relational.drifted(spark, str(tmp_path)).collect()} == {(1, 0, "5", "5,6"), (3, 0, "", "7")}
    found = plan(queries.QUERIES["gate_summary"](spark, DATA))
    assert "collect_list" not in found and "SortMergeJoin [__word" not in found
