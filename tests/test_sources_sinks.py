import json
import os

import pytest

from millrace.functions.unicode import html_text, repair, stable_id
from millrace.operators.graph import build_edges, normalize_triples
from millrace.sinks.curated import configuration_hash, file_hashes, read_manifest, write_curated
from millrace.sinks.export import export, publish, turtle_lines, upload
from millrace.sources.archive import append_versions, document_history, latest_versions, read_archive
from millrace.sources.files import load, read_jsonl
from millrace.sources.web import crawl, fetch, page_records, plan_seeds, sitemap_urls
from millrace.streaming.incremental import current_edges, start

TRIPLES = "pos bigint, subject string, predicate string, object string, evidence_sentence string, source_chunk_id string, description string, confidence double"


def test_load_all_formats(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.txt").write_text("whole\nfile")
    (tmp_path / "sub/b.json").write_text(json.dumps([{"text": "one", "id": "i1", "lang": "vi"}, {"content": "two", "url": "u2"}]))
    (tmp_path / "sub/c.json").write_text(json.dumps({"text": "three", "title": "lost"}))
    (tmp_path / "d.jsonl").write_text('{"text": "four", "id": "i4", "title": "t"}\n\n{"text": "five"}\n')
    (tmp_path / "e.csv").write_text('name,Body\nx,"six, ""quoted""\nline"\n')
    (tmp_path / "f.bin").write_text("no")
    rows = {r.content: r for r in load(spark, [str(tmp_path)]).collect()}
    assert set(rows) == {"whole\nfile", "one", "two", "three", "four", "five", 'six, "quoted"\nline'}
    assert rows["one"].doc_id == "i1" and rows["one"].metadata == {"lang": "vi"} and rows["two"].doc_id == "u2"
    assert rows["three"].metadata == {} and rows["four"].metadata == {"title": "t", "upload_date": ""}
    assert sorted(r.pos for r in rows.values()) == list(range(7))
    assert load(spark, [str(tmp_path / "f.bin")]).count() == 0


def test_malformed_lines(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"text": "ok"}\n{broken\n')
    with pytest.raises(Exception):
        read_jsonl(spark, str(tmp_path / "x.jsonl")).collect()
    assert [r.content for r in read_jsonl(spark, str(tmp_path / "x.jsonl"), tolerant=True).collect()] in (["ok"], ["ok", ""])


def test_web(spark):
    maps = spark.createDataFrame([('<urlset xmlns="http://x"><url><loc> https://a.vn/1 </loc></url><url><loc>https://a.vn/2</loc></url></urlset>',)], "xml string")
    assert {r.url for r in sitemap_urls(maps, "xml").collect()} == {"https://a.vn/1", "https://a.vn/2"}
    links = spark.createDataFrame([("https://a.vn/", "https://a.vn/1#x"), ("https://a.vn/1", "https://a.vn/2"), ("https://a.vn/2", "https://a.vn/3"), ("https://a.vn/", "https://b.vn/1")], "source string, target string")
    got = {(r.url, r.depth) for r in crawl(links, spark.createDataFrame([("https://a.vn/",)], "url string"), 2).collect()}
    assert got == {("https://a.vn/", 0), ("https://a.vn/1", 1), ("https://a.vn/2", 2)}
    seeds = spark.createDataFrame([("https://a.vn/", "auto"), ("https://a.vn/x", "auto"), ("https://a.vn/", "crawl")], "url string, mode string")
    assert [r.plan for r in plan_seeds(seeds).collect()] == ["sitemap,crawl", "exact", "crawl"]

    def get(u):
        if u.endswith("3"):
            raise OSError("down")
        return 200, f"<html><title>T</title><p>{'abcdefghijklmnopqrstuvwxyz ' * 5}{u}</p></html>"

    pages = fetch(spark.createDataFrame([(f"https://a.vn/{i}",) for i in range(4)], "url string"), get, lambda u: not u.endswith("2"))
    rows = {r.url[-1]: r for r in pages.collect()}
    assert rows["2"].error == "blocked" and rows["3"].error == "down" and rows["0"].status == 200
    recs = page_records(pages, least_unique=20).collect()
    assert len(recs) == 2 and recs[0].title == "T" and recs[0].source_domain == "a.vn" and recs[0].inferred_type == "landing_page"


def test_archive(spark, tmp_path):
    path = str(tmp_path / "arch")
    batch = lambda *rows: spark.createDataFrame(rows, "canonical_id string, content string")
    first = {r.canonical_id: r.status for r in append_versions(read_archive(spark, path), batch(("a", "1"), ("b", "1"), (None, "x"), ("a", "1")), path).collect()}
    assert first == {"a": "new", "b": "new"}
    history = read_archive(spark, path)
    second = {r.canonical_id: (r.status, r.version) for r in append_versions(history, batch(("a", "2"), ("b", "1")), path).collect()}
    assert second["b"] == ("unchanged", 1) or second["b"][0] == "unchanged"
    now = {r.canonical_id: (r.version, r.content) for r in latest_versions(read_archive(spark, path)).collect()}
    assert now == {"a": (2, "2"), "b": (1, "1")}
    assert document_history(read_archive(spark, path)).where("previous_hash is not null").count() == 1


def _graph(spark):
    t = spark.createDataFrame([(1, "a", "knows", "b", "e1", "d#0", "first", 0.5), (2, "b", "knows", "a", "e2", "d#1", "second", 0.5), (3, "a", "made", "c", None, None, None, None), (4, "a", "made", "a", "x", "d#0", None, None), (5, None, "made", "c", None, None, None, None)], TRIPLES)
    return build_edges(normalize_triples(t))


def test_edges_and_exports(spark, tmp_path):
    edges = _graph(spark)
    rows = {(r.subject, r.object): r for r in edges.collect()}
    assert set(rows) == {("a", "b"), ("a", "c")} and rows["a", "b"].source_chunk_ids == ["d#0", "d#1"] and rows["a", "b"].description == "second" and rows["a", "b"].weight == 1
    nodes = spark.createDataFrame([("a", "A & co", "ORG"), ("b", "B", "Document"), ("c", "C", "Chunk")], "id string, name string, type string")
    assert export(nodes, edges, str(tmp_path / "out"), ["json", "graphml", "neo4j_csv", "rdf", "cytoscape", "nope"]) == ["nope"]
    assert sorted(r.value for r in turtle_lines(edges).collect()) == ["ent:a kg:knows ent:b .", "ent:a kg:made ent:c ."]
    xml = "".join(open(os.path.join(tmp_path, "out/graphml", f)).read() for f in sorted(os.listdir(tmp_path / "out/graphml")) if f.startswith("part"))
    assert "A &amp; co" in xml
    assert sum(r.sent for r in upload(edges, lambda rows: None).collect()) == 2


def test_publish_once(tmp_path):
    path = str(tmp_path / "corpus")
    write = lambda p: open(os.path.join(p, "x"), "w").close()
    assert publish(write, path, "s1") == "published" and publish(write, path, "s1") == "kept"
    with pytest.raises(FileExistsError):
        publish(write, path, "s2")
    assert configuration_hash({"a": 1, "b": 2}) == configuration_hash({"b": 2, "a": 1})


def test_manifest_and_curated(spark, tmp_path):
    m = tmp_path / "m.json"
    m.write_text(json.dumps({"dataset_name": "d", "version": "1", "license": " ", "source": "s"}))
    with pytest.raises(ValueError):
        read_manifest(spark, str(m))
    m.write_text(json.dumps({"dataset_name": "d", "version": "1", "license": "x", "source": "s", "language": "vi"}))
    assert read_manifest(spark, str(m)).first().language == "vi"
    rec = spark.createDataFrame([("p", 1, "b"), ("p", 0, "a")], "parent_id string, segment int, text string")
    audit = spark.createDataFrame([("p", ["x", "y"])], "doc_id string, flags array<string>")
    write_curated(rec, audit, audit, str(tmp_path / "c"))
    assert spark.read.csv(str(tmp_path / "c/audit"), header=True).first().flags == "x;y"
    assert file_hashes(spark, str(tmp_path / "c/curated")).where("length > 0").count() >= 1


def test_stream_replaces_documents(spark, tmp_path):
    src, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    row = lambda pos, o, chunk: (pos, "a", "made", o, "e", chunk, None, None)
    spark.createDataFrame([row(1, "b", "d1#0"), row(2, "c", "d2#0")], TRIPLES).coalesce(1).write.parquet(src)
    stream = lambda: spark.readStream.schema(TRIPLES).parquet(src)
    start(stream(), out, ck).awaitTermination()
    spark.createDataFrame([row(3, "z", "d1#0")], TRIPLES).coalesce(1).write.mode("append").parquet(src)
    start(stream(), out, ck).awaitTermination()
    assert {(r.subject, r.object) for r in current_edges(spark, out).collect()} == {("a", "c"), ("a", "z")}


def test_unicode_functions():
    assert repair("ã̃") == "ã" and stable_id("e", "A  b", None) == stable_id("e", "ａ B", "") != stable_id("e", "ab", "")
    assert html_text("<title> a  b </title><script>x</script><p>one &amp; <b>two</b></p><div>three<br>four</div>") == ("a b", "one & two\nthree\nfour")
