"""Search, chat formatting, URL filters and the pipeline against brute force."""

import hashlib
import math

import pytest
from pyspark.sql import functions as F

from battlelake.llm import chat, search, urls


def brute_top(rows, k=5):
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for q, a in {(i, tuple(v)) for i, v in good if i % 50 == 0}:
        scores = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in good if i != q and len(b) == len(a))
        out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])}
    return out


def test_search_with_ties_and_bad_vectors(spark, rng, monkeypatch):
    rows = [(i, [rng.choice([0.5, -0.5, 1.0]) if i % 3 == 0 else rng.uniform(-1, 1) for _ in range(6)]) for i in range(300)]
    rows += [(1000 + i, [0.25] * 6) for i in range(150)]
    rows += [(400, None), (450, [None] * 6), (500, [float("nan")] * 6), (550, [float("inf")] + [0.0] * 5), (600, [1.0, 2.0]), (None, [1.0] * 6), (601, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    monkeypatch.setattr(search, "BLOCK_ROWS", 64)
    got = {tuple(r) for r in search.top_k(df, F.col("vec_id") % 50 == 0).collect()}
    assert got == brute_top(rows)
    assert search.top_k(df.limit(0), F.col("vec_id") % 50 == 0).collect() == []


def test_chat_reads_back(spark, rng):
    parts = ["\\", "#", "</turn>", "\n", "### ", "x", ": ", "<", "é", "🙂"]
    rows = [(c, t, rng.choice(["user", "assistant", "assistant", "a:b#", None]), rng.choice([None, *["".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(4)]]))
            for c in [None, *range(40)] for t in range(rng.randrange(0, 6))] + [(3, None, "user", "x"), (3, 1, "user", "y"), (3, 1, "user", "y")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("part", F.lit(1))
    got = {r["conv_id"]: r for r in chat.report(df).collect()}
    grouped = {}
    for c, t, role, text in [*rows, *chat.CONTROL_TURNS]:
        grouped.setdefault(c, []).append(((t is not None, t or 0), (role is not None, role or ""), (text is not None, text or "")))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got.keys() == grouped.keys()
    for c, turns in grouped.items():
        turns = [(r[1], x[1]) for _, r, x in sorted(turns)]
        loss = "".join(x for r, x in turns if r == "assistant")
        assert (got[c]["n_turns"], got[c]["turns_sha256"]) == (len(turns), sha("".join(f"{r}\n{x}\n" for r, x in turns)))
        assert (got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(loss), sha(loss))
    whole = {r["conv_id"]: r["n"] for r in chat.formatted(chat.with_control(df)).groupBy("conv_id").agg(F.sum(F.length("text")).alias("n")).collect()}
    assert whole == {c: r["formatted_chars"] for c, r in got.items()}
    assert [r["conv_id"] for r in chat.report(df.limit(0)).collect()] == [-7]


def test_template_language():
    t = chat.Template("{% set x = 'a' ~ 1 %}{% for m in messages %}{% if loop.first %}[{% elif m.n == 2 and not loop.last %}two{% else %}-{% endif %}"
                      "{{ m['t'] | trim | upper }}{% generation %}{{ x }}{% endgeneration %}{% endfor %}{{ 'z' + 'y' }}{% if 1 == 2 %}never{% endif %}")
    text, spans = t.render([{"n": 1, "t": " a "}, {"n": 2, "t": "b"}, {"n": 3, "t": None}])
    assert text == "[Aa1twoBa1-a1zy" and [text[a:b] for a, b in spans] == ["a1"] * 3
    assert t.tree[-1] == ("text", "zy") and t.tree[0] == ("set", "x", ("const", "a1"))
    assert chat.Template("{{ m.__class__ }}").render([], m="s")[0] == ""
    for bad in ("{% for %}", "{{ a | nope }}", "{% if a %}", "{{ 'a }}", "{% import os %}"):
        with pytest.raises(chat.TemplateError):
            chat.Template(bad)


def brute_url(url):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        n = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:n])
        path = rest[n:].split("?")[0].split("#")[0]
    fits = [r for r in urls.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.host + r.path), default=None)
    return host, path, best and best.host + best.path, best and best.verdict


def test_urls(spark, sf_dir):
    odd = [None, "", "no scheme", "http://", "HTTP://Example.ORG/es/1", "x://a.example.org/en/12", "http://example.org", "http://notexample.org/es/", "a://b://c/d",
           "http://com/fr/x", "http://x.com?u=/de/", "http://x.com/de/a/b/c/d/e/f/g/h", "http://x.com/de#f", "http://É.COM/fr/ü"]
    pages = spark.createDataFrame(list(enumerate([*odd, *odd])), "page_id long, url string").withColumn("host", F.lit("clash"))
    labels = spark.createDataFrame([(1, 1, 0), (12, None, 1), (None, 1, 1), (1, 1, None)], "doc_id long, quality int, toxic int")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.report(pages, labels).collect()}
    for i, url in enumerate([*odd, *odd]):
        host, path, rule, verdict = brute_url(url)
        assert got[i][:3] == (host, path, rule) and got[i][3] == (verdict or "allow")
    assert urls.report(pages.limit(0), labels).collect() == []


def test_bad_templates_are_rejected(spark):
    """A branch of bad pages goes, its host's good branch stays, and words generalise where they are many."""
    rows = [(i, f"http://h.net/spam/w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}x", i) for i in range(300)]
    rows += [(1000 + i, f"http://h.net/news/{i}", 1000 + i) for i in range(300)]
    pages = spark.createDataFrame(rows, "page_id long, url string, label_key long")
    labels = spark.createDataFrame([(i, i >= 1000) for i, _, _ in rows if i % 3], "label_key long, good boolean")
    found = urls.filter_urls(pages, labels).groupBy("template", "verdict").count().collect()
    assert {(r["template"], r["verdict"]): r["count"] for r in found} == {("/spam/{word}", "block"): 300, ("/news/{number}", "allow"): 300}


def test_pipeline(spark, sf_dir):
    import corpus_pipeline

    from battlelake import session

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES:
        docs = session.cut_lineage(stage(spark, docs, sf_dir))
        assert 0 < docs.count() <= before
        before = docs.count()
        assert docs.columns == columns or name == "bpe"
    assert docs.where("NOT round_trip").count() == 0


@pytest.mark.parametrize("above", ["/a/b", "/a/b/c/d/e/f/g/h/i/j"])
def test_branches_are_told_apart_at_any_depth(spark, above):
    pages = spark.createDataFrame(
        [(i, f"http://h.net{above}/{'good' if i % 2 else 'bad'}/x{chr(97 + i % 26)}{chr(97 + i // 26)}", i) for i in range(400)],
        "page_id long, url string, label_key long")
    labels = spark.range(400).selectExpr("id AS label_key", "id % 2 = 1 AS good")
    got = urls.filter_urls(pages, labels).collect()
    assert len(got) == 400 and all((r["verdict"] == "allow") == (r["page_id"] % 2 == 1) for r in got)
    deep = spark.createDataFrame([(1, "http://d.net/" + "/".join("s" * (1 + k % 5) for k in range(900)), 1)], pages.schema)
    assert urls.filter_urls(deep, labels).count() == 1
