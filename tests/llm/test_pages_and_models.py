"""Pages, archives, the classifier, the pipeline and the registered queries."""

import base64
import hashlib
import os
import sys

import numpy as np
import pytest

from tastemill.llm import html_templates, quality, queries, warc

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from oracle_check import compare, connect  # noqa: E402


def page(body, notice="Share this page"):
    return (f'<html><head><title>t</title><script>var a="</p>";</script></head><body><nav><ul><li><a href="/x">Home</a></li></ul></nav>'
            f'<div class="ad box">Buy</div><div class="cookie-notice">We use cookies</div><article><h1>Head &amp; line</h1><p>{notice}</p>{body}'
            f'<section id="comments"><p>nice</p></section></article><aside>side</aside><form>f</form><footer>foot</footer></body></html>')


def test_main_text():
    text = html_templates.main_text(page("<p><b>One  <i>two</i>\nthree<br>four<p>Five&nbsp;six</p>"))
    assert text == "Head & line\nShare this page\nOne two three four\nFive six"
    assert html_templates.main_text("") == "" and html_templates.main_text("just text < here") == "just text < here"
    assert html_templates.main_text("<p>a</p><nav>n<p>b</nav><p>c") == "a\nc"
    assert html_templates.main_text("<!-- x <article><p>cut") == ""
    assert html_templates.main_text("<p>" * 3000 + "deep") == "deep"


def test_template_text_is_dropped(spark):
    rows = [(k, "http://h.example/a", page(f"<p>text {k}</p>")) for k in range(20)]
    rows += [(100 + k, "http://small.example/", page("<p>copy</p>")) for k in range(30)]
    rows += [(200, None, None), (201, None, ""), (202, "http://h.example/a", ""), (203, "http://h.example/a", None), (5, "http://h.example/a", page("<p>text 5</p>"))]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, text string")
    found = {}
    for r in html_templates.extract(pages).collect():
        found.setdefault(r.page_id, []).append((r.text, r.n_chars))
    # the repeated notice, and here the heading too, are template text of a host with many different pages
    assert found[3] == [("text 3", 6)] and found[5] == [("text 5", 6)] * 2
    # copies of one page are no evidence of a template
    assert found[101][0][0].endswith("copy") and found[101][0][0].startswith("Head & line")
    assert found[200] == [("", 0)] == found[201]
    classes = {r.host: r.classes for r in html_templates.deduce_templates(pages).collect()}
    assert set(classes) == {"h.example"} and classes["h.example"][0].is_root
    assert html_templates.extract(pages.where("false")).count() == 0


def test_classes_nest_and_their_slots_decide(spark):
    def shop(k):
        # two repeated lines on most pages; a slot whose advert lacks its mark on one page, beside text of another path there
        mark = "" if k == 3 else ' class="ad"'
        extra = "<p>Delivered within two days</p><b>Ask us for sizes</b>" if k % 4 else ""
        intro = f"<h2>intro {k}</h2>" if k == 3 else ""
        rows = "".join(f"<li><i>{k} {j}</i></li>" for j in range(1 + k % 3))
        return f"<html><body><div{mark}>offer {k}</div>{intro}<section><h1>item {k}</h1><ul>{rows}</ul>{extra}<p>about {k}</p></section><span>end</span></body></html>"

    rows = [(k, "http://shop.example/i", shop(k)) for k in range(20)] + [(100 + k, "http://few.example/i", shop(k)) for k in range(7)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: r.text for r in html_templates.extract(pages).collect()}
    assert found[3] == "intro 3\nitem 3\n3 0\nabout 3"
    assert found[5] == "item 5\n5 0\n5 1\n5 2\nabout 5"
    assert found[103] == "offer 3\nintro 3\nitem 3\n3 0\nDelivered within two days\nAsk us for sizes\nabout 3\nend"
    (template,) = html_templates.deduce_templates(pages).collect()
    name = lambda path, text="": html_templates._token(path, text)
    where = {t: (k, rank) for k, c in enumerate(template.classes) for rank, t in enumerate(c.tokens)}
    assert template.host == "shop.example" and template.classes[0].is_root and template.classes[0].parent == -1
    (item,) = {where[name(p)][0] for p in ("html/body/section/ul/li", "html/body/section/ul/li/i", "html/body/section/ul/li/i//i", "html/body/section/ul/li//li")
               if name(p) in where}
    around = template.classes[template.classes[item].parent]
    assert around.is_root and around.tokens[template.classes[item].gap] == name("html/body/section/ul")
    assert set(template.text_tokens) == {name("html/body/section/p", "Delivered within two days"), name("html/body/section/b", "Ask us for sizes"), name("html/body/span", "end")}


def test_nesting_leaves_out_classes_that_cross():
    one = lambda n: {"tokens": list(range(n))}
    rel = lambda a, b, low, high=None: {"a": a, "b": b, "low": low, "high": low if high is None else high}
    across = html_templates._ACROSS
    # 1 in a gap of 0, 2 in a gap of 1, 3 crosses 1, 4 in changing gaps of 0, 5 apart from all
    relations = [rel(1, 0, 2), rel(2, 0, 2), rel(2, 1, 1), rel(3, 0, 2), rel(1, 3, across), rel(3, 1, across), rel(4, 0, 0, 3), rel(0, 4, across)]
    relations += [rel(0, b, across) for b in (1, 2, 3)] + [rel(1, 2, across)] + [rel(5, b, -1) for b in range(5)] + [rel(a, 5, -1) for a in range(5)]
    valid = html_templates.nest([one(k + 2) for k in range(6)], relations)
    assert [(len(c["tokens"]) - 2, c["parent"], c["gap"]) for c in valid] == [(0, -1, 0), (1, 0, 2), (2, 1, 1), (5, -1, 0)]


def test_warc(spark, tmp_path):
    tricky = "WARC/1.1\r\nWARC-Type: response\r\n\r\n\r\n\r\nWARC/1.1"
    rows = [(1, "http://a/", "x"), (2, "http://b/", tricky), (3, None, "x"), (4, "http://c/", None), (9, "http://d/", ""), (7, "u\r\nx: y", "é"), (9, "http://d/", ""), (None, "n", "x")]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, digest string")
    warc.write_archive(pages, str(tmp_path / "w"))
    records = warc.read_records(spark, str(tmp_path / "w"), with_payload=True)
    assert records.count() == 3 * len(rows)
    found = warc.assemble(records).collect()
    assert len(found) == len(rows)
    top = {"x": 3, tricky: 2, "": 9, "é": 7}
    by_page = {p: h or "" for p, _, h in rows}
    for r in found:
        body = by_page[r.page_id]
        assert bytes(r.response.payload).decode() == body and r.response.payload_bytes == len(body.encode())
        assert r.response.payload_digest == base64.b32encode(hashlib.sha1(body.encode()).digest()).decode()
        again = r.page_id != top[body]
        assert r.response.kind == ("revisit" if again else "response") and r.response.refers_to == (top[body] if again else None)
        assert r.request.record_id and r.metadata.page == ("null" if r.page_id is None else str(r.page_id))
    warc.write_archive(pages.where("false"), str(tmp_path / "e"))
    assert warc.assemble(warc.read_records(spark, str(tmp_path / "e"))).count() == 0


def test_warc_keeps_payloads_of_one_page_id_apart(spark, tmp_path):
    rows = [(1, "u", "x"), (3, "u", "x"), (3, "u", ""), (2, "v", "y" * 3_000_000), (4, "v", "y" * 3_000_000)]
    warc.write_archive(spark.createDataFrame(rows, "page_id long, url string, html string"), str(tmp_path / "w"))
    found = warc.assemble(warc.read_records(spark, str(tmp_path / "w"), with_payload=True)).collect()
    assert sorted((r.page_id, r.response.kind, r.response.payload_bytes, r.response.refers_to) for r in found) == [
        (1, "revisit", 1, 3), (2, "revisit", 3_000_000, 4), (3, "response", 0, None), (3, "response", 1, None), (4, "response", 3_000_000, None)]
    assert all(len(r.response.payload) == r.response.payload_bytes for r in found)
    with pytest.raises(ValueError):
        list(warc.parse_records([b"WARC/1.1\r\nContent-Length: 9\r\n\r\nshort"]))


def test_quality(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/{t}.parquet") for t in ("documents", "labels"))
    vectors, network = quality.train(docs, labels)
    scored = quality.score(docs, vectors, network).join(labels, "doc_id").where(quality.held_out(labels.doc_id)).collect()
    right = sum((r.score >= quality.THRESHOLD) == bool(r.quality) for r in scored)
    assert right / len(scored) > 0.9
    odd = spark.createDataFrame([(1, None, 5), (2, "", 5), (None, "word", 5), (1, None, 5)], "doc_id long, text string, score long")
    assert all(0 <= r.score <= 1 for r in quality.score(odd, vectors, network).collect())
    assert quality.keep_quality(docs, labels).columns == docs.columns
    blank = quality.train(odd, labels.where("false"))
    assert {r.score for r in quality.score(odd, *blank).collect()} == {0.5}
    assert quality.score(odd.where("false"), *quality.train(odd.where("false"), labels)).count() == 0


def test_network_temperature():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 5)).astype(np.float32)
    y = (rng.random(2000) < 1 / (1 + np.exp(-2 * x[:, 0]))).astype(float)
    network = quality.fit(x, y)
    scores = network.scores(x)
    assert abs(scores.mean() - y.mean()) < 0.05 and ((scores > 0.5) == y).mean() > 0.75


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries(spark, sf_dir, duck, name):
    df = queries.QUERIES[name](spark, sf_dir)
    if name in queries.ORACLES:
        ok, note = compare(df, duck, queries.ORACLES[name])
        assert ok, note
    else:
        assert df.count() == spark.read.parquet(f"{sf_dir}/{'pages' if name in ('op1_html_templates', 'op3_warc') else 'documents'}.parquet").count()


def test_pipeline(spark, sf_dir):
    """Every stage against its operator's decisions on what the stage before it kept."""
    pipeline = pytest.importorskip("corpus_pipeline")
    from tastemill.llm import decontaminate, pii, simhash
    from tastemill.session import cut_lineage

    docs, seen = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    columns = docs.columns
    for name, stage in pipeline.STAGES:
        seen.append((name, docs))
        docs = cut_lineage(stage(spark, docs, sf_dir))
        assert name == "tokens" or docs.columns == columns
    ids = [sorted(r.doc_id for r in d.select("doc_id").collect()) for _, d in seen] + [sorted(r.doc_id for r in docs.collect())]
    roots = simhash.near_duplicates(seen[1][1]).collect()
    assert ids[2] == sorted(r.doc_id for r in roots if r.doc_id == r.component_id)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    assert ids[3] == sorted(r.doc_id for r in decontaminate.find_matches(seen[2][1], benchmark).where("n_hit = 0").collect())
    clean = {r.doc_id: r.text for r in seen[4][1].collect()}
    assert clean == {r.doc_id: pii.redact(r.text) for r in seen[3][1].collect()}
    tokens = {r.doc_id: r.decoded_sha256 for r in docs.collect()}
    assert tokens == {d: hashlib.sha256(t.encode()).hexdigest() for d, t in clean.items()}
    assert len(ids[0]) > len(ids[1]) > len(ids[2]) > len(ids[3]) == len(ids[4]) == len(ids[5]) > 0


def test_pipeline_stages_on_odd_rows(spark, sf_dir):
    """Nulls, blanks, repeated rows, one doc_id with two texts, an extra column, and no rows at all."""
    pipeline = pytest.importorskip("corpus_pipeline")
    from tastemill.session import cut_lineage

    first, second = (" ".join(f"{w}{k}" for k in range(50)) for w in ("alpha", "beta"))
    rows = [(1, first, "en", None, 3, "x"), (1, second, None, "s", None, None), (2, first, "en", "s", 1, "x"), (2, first, "en", "s", 1, "x"), (3, None, None, None, None, None),
            (4, "", "en", "s", 0, "x"), (None, "write to a@b.co now " + second, "en", "s", 9, "x"), (5, "word " * 30_000, "en", "s", 1, "x")]
    odd = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, bucket string").repartition(2)
    for docs in (odd, odd.where("false")):
        columns, sizes = docs.columns, [docs.count()]
        for name, stage in pipeline.STAGES:
            docs = cut_lineage(stage(spark, docs, sf_dir))
            sizes.append(docs.count())
            assert name == "tokens" or docs.columns == columns
            if name == "near_duplicates" and sizes[0]:
                kept = sorted((r.doc_id or 0, r.text or "") for r in docs.collect())
                # copies of the first text go, the other text of document 1 stays; nulls and blanks are one group
                assert (1, first) in kept and (1, second) in kept and not any(d == 2 for d, _ in kept) and [d for d, t in kept if not t] == [3]
        if sizes[0]:
            assert docs.where("doc_id IS NULL").count() == 1 and docs.where("doc_id = 1").count() == 2
        else:
            assert sizes == [0] * 6
