"""URL rules, archives, tool calls and the pipeline, on odd input and against brute-force versions."""

import hashlib
import json
import random
import re
import zlib

import pyarrow.fs as pafs
import pytest

import corpus_pipeline
from tidemark.llm import decontaminate, line_crf, minhash, suffix_dedup, tool_calls, url_rules, warc

PAGES = "page_id bigint, url string, html string, key string, id string, rule string, part string"


@pytest.fixture(scope="module")
def pages(spark):
    rng = random.Random(1)
    urls = [None, "", "no scheme", "http://", "https://EXAMPLE.org/es/x?q#f", "http://a.example.org/en/12", "http://example.org", "http://org/", "ftp://x.com/fr/", "http://y.com/de/1", "http://x.net/a", "http://notexample.org.evil.net/es/"]
    urls += [f"http://{rng.choice(['a.', 'b.a.', ''])}{rng.choice(['example', 'other'])}.{rng.choice(['org', 'com', 'net'])}/{rng.choice(['es/', 'en/1', 'fr/', 'de/', 'zz'])}{i % 7}" for i in range(120)]
    htmls = [None, "", "é" * 600, "é" * 600, "x" * 999, "x" * 999, "x" * 1000, "x" * 1000, "x" * 1000, "tab\there"]
    rows = [(i, u, htmls[i % len(htmls)], "k", "i", "r", "p") for i, u in enumerate(urls)]
    return spark.createDataFrame([*rows, rows[7], rows[8], (None, None, None, None, None, None, None)], PAGES)


def plain_verdict(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [(len(h + p), v == "block", h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[2], best[3] if best else default


def test_url_rules(spark, pages):
    few = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]
    many = [*few, ("block", "a.example.org", "/"), ("allow", "b.a.example.org", "/es/"), ("block", "net", ""), ("allow", "net", ""), ("block", "org", "/")]
    for rules in (few, many, [(None, None, None)]):
        out = url_rules.judge(pages, spark.createDataFrame([*rules, *rules], "verdict string, host string, path string"), default="allow")
        real = [r for r in rules if r[0]]
        rows = out.collect()
        assert len(rows) == pages.count()
        for r in rows:
            assert (r.host, r.path, r.rule, r.verdict) == plain_verdict(r.url, real)
    assert out.columns == ["page_id", "url", "html", "key", "id", "part", "host", "path", "rule", "verdict"]
    assert url_rules.judge(pages.limit(0), url_rules.rules_table(spark, few)).count() == 0


def test_archive_round_trip(spark, pages):
    archive = warc.write(pages, block_rows=7)
    out = warc.read(archive, warc.lookup(archive, warc.wanted_of(pages))).collect()
    rows = pages.collect()
    assert len(out) == len(rows)
    want = {}
    for r in rows:
        data = (r.html or "").encode()
        same = [x.page_id for x in rows if x.html == r.html and len(data) >= 1000 and x.page_id is not None]
        best = max(same, default=None)
        want[r.page_id] = (len(data), hashlib.sha1(data).hexdigest(), "response" if best in (None, r.page_id) else "revisit", None if best == r.page_id else best)
    for r in out:
        assert (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) == want[r.page_id]
    assert {r.page_id: r.payload.decode() for r in out if r.record_type == "response" and r.page_id == 9} == {9: "tab\there"}
    one = spark.createDataFrame([("org.example.)/es/x?q", 4), ("org.example.)/es/x?q", 5), ("zz", 1)], "key string, id bigint")
    assert [(r.key, r.id) for r in warc.lookup(archive, one).collect()] == [("org.example.)/es/x?q", 4)]
    empty = warc.write(pages.limit(0))
    assert warc.read(empty, warc.lookup(empty, one)).count() == 0


def test_archive_files_are_plain_warc(spark, pages):
    archive = warc.write(pages.limit(5))
    fs, root = warc._files(archive.folder)
    files = [f.path for f in fs.get_file_info(pafs.FileSelector(root)) if f.path.endswith(".warc.gz")]
    data, found = b"".join(fs.open_input_file(f).read() for f in files), []
    while data:
        one = zlib.decompressobj(31)
        found.append(warc.parse(one.decompress(data))[0])
        data = one.unused_data
    assert len(found) == 5 and all(h["WARC-Record-ID"].startswith("<urn:uuid:") for h in found)


def test_tool_calls(spark):
    calls = spark.createDataFrame(
        [
            ("c", "1", 0, "add", '{"b": 2, "a": 1}', []), ("c", "2", 1, "add", '{"a": "x", "c": 1}', ["1"]), ("c", "3", 2, "nope", "[1]", ["9"]), ("c", "3", 5, "late copy", "{}", []),
            ("d", "x", 0, "add", '{"a": 1, "b": 2}', ["y"]), ("d", "y", 1, "add", '{"a": true, "b": 2.5}', []), ("d", "z", 2, "add", None, ["w"]), ("d", "w", 3, "add", "{", ["z"]),
            (None, "1", 0, "add", "{}", []), ("e", None, 0, "add", "{}", None),
        ],
        "conv_id string, call_id string, position int, name string, arguments string, depends_on array<string>",
    )
    results = spark.createDataFrame([("c", "1", "three"), ("c", "1", "also"), ("d", "x", None), ("c", "8", "lost")], "conv_id string, call_id string, content string")
    schemas = spark.createDataFrame([("add", {"a": "integer", "b": "number"}, {}), ("add", {"a": "integer", "b": "number"}, {})], "name string, required map<string,string>, optional map<string,string>")
    got = {(r.conv_id, r.call_id): r for r in tool_calls.link(calls, results, schemas).collect()}
    assert len(got) == 7
    assert got["c", "1"].message == '{"arguments":{"a":1,"b":2},"id":"1","name":"add","result":"also","valid":true}' and got["c", "1"].n_results == 2
    assert got["c", "2"].problems == ["missing:b", "type:a", "unexpected:c", "no_result"]
    assert got["c", "3"].problems == ["bad_json", "unknown_tool", "unknown_dependency", "no_result"]
    assert {k[1]: r.level for k, r in got.items() if k[0] == "d"} == {"y": 0, "x": 1, "z": None, "w": None}
    assert got["d", "x"].valid and got["d", "y"].problems == ["type:a", "no_result"] and "cycle" in got["d", "z"].problems
    assert [r.call_id for r in tool_calls.orphans(calls, results).collect()] == ["8"]
    assert tool_calls.link(calls.limit(0), results, schemas).count() == 0
    turns = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 2, "user", None), (2, 0, "system", "s"), (None, None, None, None)], "conv_id bigint, turn bigint, role string, text string")
    linked = {(r.conv_id, r.call_id): r for r in tool_calls.link(*tool_calls.calls_of_chat(turns), schemas).collect()}
    assert linked["1", "call-0"].content == "b" and json.loads(linked["1", "call-2"].arguments) == {"chars": 0, "prompt": ""}


def brute_levels(needs):
    """needs: call -> calls. The longest chain of known dependencies; None on or behind a cycle."""
    known = {c: [n for n in own if n in needs] for c, own in needs.items()}
    out = {}
    while ready := {c: 1 + max((out[n] for n in own), default=-1) for c, own in known.items() if c not in out and all(n in out for n in own)}:
        out |= ready
    return {c: out.get(c) for c in needs}


def test_levels_equal_brute_force(spark):
    """Random graphs, long chains, forks, joins, cycles of one, two and many calls, calls behind them; one conversation far larger than the others."""
    rng = random.Random(7)
    graphs = {}
    for g in range(30):
        n = rng.randrange(1, 14)
        graphs[f"r{g}"] = {f"c{i}": [f"c{rng.randrange(n + 1)}" for _ in range(rng.choice([0, 1, 1, 1, 2, 3]))] for i in range(n)}
    graphs["chain"] = {f"c{i}": [f"c{i - 1}"] if i else [] for i in range(700)}
    graphs["ahead"] = {f"c{i}": [f"c{i + 1}"] if i < 60 else [] for i in range(61)}
    graphs["ring"] = {f"c{i}": [f"c{(i + 1) % 40}"] for i in range(40)} | {"behind": ["c3"], "farther": ["behind", "free"], "free": []}
    graphs["braid"] = {f"c{i}": [f"c{i - 1}", f"c{i - 2}"] if i > 1 else [] for i in range(8)}
    rows = [(g, c, needs) for g, graph in graphs.items() for c, needs in graph.items()]
    got = {(r.conv_id, r.call_id): r.level for r in tool_calls.levels(spark.createDataFrame(rows, "conv_id string, call_id string, depends_on array<string>")).collect()}
    assert got == {(g, c): v for g, graph in graphs.items() for c, v in brute_levels(graph).items()}
    assert got["chain", "c699"] == 699 and got["ring", "farther"] is None and got["ring", "free"] == 0


def test_tool_calls_with_odd_columns_and_long_arguments(spark):
    """Columns that operators use inside, very long arguments, nulls in every column."""
    long = json.dumps({"a": 1, "b": 2.5, "c": "é" * 300_000})
    calls = spark.createDataFrame([("c", "1", 0, "add", long, None, "x", 1, "u"), ("c", "2", None, None, None, [None, "1"], None, None, None)], "conv_id string, call_id string, position int, name string, arguments string, depends_on array<string>, level string, n int, up string")
    results = spark.createDataFrame([("c", "1", "r", "z", 3)], "conv_id string, call_id string, content string, level string, n_results int")
    schemas = spark.createDataFrame([("add", {"a": "integer", "b": "number"}, {"c": "string"}, True)], "name string, required map<string,string>, optional map<string,string>, known boolean")
    got = {r.call_id: r for r in tool_calls.link(calls, results, schemas).collect()}
    assert got["1"].valid and len(got["1"].arguments) == len(json.dumps(json.loads(long), ensure_ascii=False, separators=(",", ":"))) and got["1"].level == 0
    assert got["2"].level == 1 and got["2"].problems == ["bad_json", "unknown_tool", "no_result"]


@pytest.mark.parametrize("name", ["op3_decontamination", "op4_tool_calls", "op5_url_rules", "op8_warc"])
def test_queries_equal_their_sql(spark, name):
    import duckdb

    from tidemark.llm.queries import ORACLES, QUERIES

    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations", "pages"):
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    out = QUERIES[name](spark, sf)
    columns = ", ".join(f'"{c}"' for c in out.columns)
    want = con.execute(f"select {columns} from ({ORACLES[name]})").fetchall()
    got = [tuple(r) for r in out.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    if name == "op4_tool_calls":
        seen = {p for r in out.collect() for p in r.problems.split(",")}
        assert seen >= {"", "cycle", "unknown_dependency", "no_result", "bad_json", "unknown_tool", "missing:prompt", "type:chars", "unexpected:loud", "orphan"}
        assert len({r.level for r in out.collect()}) > 3


def brute_clean(text, items, window=10):
    """The text without the words of any item's window, a line end in place of each run of them; None if over 0.8 of its words go."""
    data = text.encode()
    fold = data.translate(decontaminate._FOLD)
    places = [m.span() for m in re.finditer(rb"[^ ]+", fold)]
    words = [fold[a:b] for a, b in places]
    hit = set()
    for own in items:
        k = min(window, len(own))
        patterns = {tuple(own[i : i + k]) for i in range(len(own) - k + 1)} if k else set()
        for i in range(len(words) - k + 1) if k else ():
            if tuple(words[i : i + k]) in patterns:
                hit |= set(range(i, i + k))
    if len(hit) > 0.8 * len(words):
        return None
    out, at = b"", 0
    for i in sorted(hit):
        if i - 1 not in hit:
            out += data[at : places[i][0]] + b"\n"
        at = places[i][1]
    return (out + data[at:]).decode()


def test_pipeline_equals_plain_python(spark):
    """The pipeline over the smallest tables against plain versions of its stages; only the field's weights are the operator's."""
    from test_documents import brute_groups, brute_passages, plain_verdict

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = line_crf.train(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    kept = {r.doc_id: r.text for r in docs.collect() if plain_verdict(r.text, model)[1]}
    groups = brute_groups(list(kept.items()), 5, 80)
    kept = {d: kept[d] for d, _, first in groups if first in (None, d)}
    passages = brute_passages(list(kept.values()), suffix_dedup.LENGTH, 51)
    items = [decontaminate.words_of(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    want = {d: brute_clean(t, items) for d, (gone, t) in zip(kept, passages, strict=True) if not gone or t}
    want = {d: t for d, t in want.items() if t is not None}
    got = corpus_pipeline.run(spark, sf).collect()
    assert {r.doc_id: r.text for r in got} == want
    assert len(got) == len(want) and any(t != docs_text for t, docs_text in zip(want.values(), kept.values(), strict=False))
    assert minhash.ROWS * 36 == minhash.SLOTS


def test_stages_keep_columns_and_take_empty_tables(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs.limit(0), sf)
        assert out.columns == docs.columns and out.count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), sf).count() == 0


def test_pipeline_keeps_one_of_repeated_and_null_id_rows(spark):
    """Repeated rows, null-id copies and two texts of one id, all of over 400 bytes, through near-dedup and passages."""
    text = lambda seed: " ".join(f"{seed}{i}" for i in range(130))
    made = [(1, "twice"), (1, "twice"), (2, "bare"), (None, "bare"), (None, "nameless"), (None, "nameless"), (3, "first"), (4, "first"), (4, "own")]
    rows = [(i, text(t), "en", t) for i, t in made]
    docs = spark.createDataFrame([*rows, (9, "", "en", "blank"), (9, "", "en", "blank")], "doc_id bigint, text string, lang string, source string")
    kept = corpus_pipeline.near_dedup(spark, docs, "")
    assert kept.columns == docs.columns
    want = [(1, "twice"), (2, "bare"), (3, "first"), (4, "own"), (None, "nameless")]
    assert sorted(((r.doc_id, r.source) for r in kept.where("source <> 'blank'").collect()), key=str) == sorted(want, key=str)
    assert kept.where("source = 'blank'").count() == 2
    out = corpus_pipeline.passage_dedup(spark, kept, "").where("source <> 'blank'").collect()
    assert sorted(((r.doc_id, r.text) for r in out), key=str) == sorted(((i, text(t)) for i, t in want), key=str)


def test_stages_take_odd_rows(spark):
    """Nulls in any column, empty and very long texts, repeated rows and clashing columns pass through every stage."""
    rng = random.Random(2)
    prose = " ".join("".join(rng.choice("abcdefg") for _ in range(rng.randrange(2, 9))) for _ in range(15_000))
    rows = [(1, prose, "en", None, None, "r", "t", 1), (2, None, None, None, None, None, None, None), (None, "", "en", "s", 0, None, None, None), (3, "x" * 5000, "en", "s", 5000, "r", "t", 2), (4, prose[:900], None, "s", 900, "r", "t", 3), (4, prose[:900], None, "s", 900, "r", "t", 3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, t string, ref int")
    sf = "/root/testdata/sf0.001"
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns, name
        got = {r.doc_id: r for r in out.collect()}
        if name == "near_dedup":
            assert sorted(got, key=str) == [1, 2, 3, 4, None] and out.count() == 5
        if name == "benchmark_decontamination":
            assert out.count() == docs.count() and got[1].text == prose
    coded = {r.doc_id: r for r in corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()}
    assert coded[1].text == prose and coded[3].text == "x" * 5000 and coded[2].n_tokens == 0
