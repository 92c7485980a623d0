"""URL filter, chat formatting, WARC audit and the pipeline against plain Python."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import brute
import pytest
from pyspark.sql import functions as F
from test_documents import DOCS, awkward

import corpus_pipeline
from winnowmill.llm import chat, urls, warc
from winnowmill.llm.queries_urls import RULES

URLS = [
    None, "", "no scheme", "://", "http://", "HTTP://EXAMPLE.NET/en/1", "http://a.example.net/en", "x://org/fr/",
    "x://b.org/fr/2?q=/#z", "x://sorg/fr/2", "x://d.example.com/de/7#a", "x://example.com/de", "x://net", "x://net/",
    "x://a.net?p=/x", "x://É.org/FR/", "x://h//", "x://h/*/a|b/%41", "x://h/a b\nc/d", "http://u@h:80/x://y/z",
]


def made_urls():
    random_ = random.Random(8)
    out = list(URLS) * 2
    for i in range(900):
        part = random_.choice(["good", "bad", "en", "fr"])
        tail = random_.choice(["", "/", ".html", "/deep/er/and/so/on/x/y/z/w"])
        out.append(f"http://www.site{i % 3}.com/{part}/{random_.randrange(10**6)}{tail}")
    return out


@pytest.fixture(scope="module")
def judged(spark):
    rows = list(enumerate(made_urls()))
    random_ = random.Random(9)
    labels = {}
    for _, url in rows:
        host, path = brute.host_and_path(url)
        if random_.random() < 0.5:
            labels[host, path] = int(random_.random() < (0.95 if "/bad/" in path else 0.05))
    pages = spark.createDataFrame(rows, "page_id bigint, url string")
    known = spark.createDataFrame([(*k, v) for k, v in labels.items()], "host string, path string, bad int")
    return rows, labels, pages, known


def test_urls_against_loops(judged):
    rows, labels, pages, known = judged
    got = {r["page_id"]: r for r in urls.filter_urls(pages, known, RULES).collect()}
    places = [brute.host_and_path(u) for _, u in rows]
    trees = brute.templates([(h, p, labels.get((h, p))) for h, p in places])
    for (i, _), (host, path) in zip(rows, places):
        template, purity = trees[host, path]
        rule, verdict = brute.rule_of(host, path, RULES)
        r = got[i]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["template"] == template and r["purity"] == pytest.approx(purity)
        assert r["verdict"] == (verdict or ("block" if purity >= 0.5 else "allow"))
    made = [r for r in got.values() if r["rule"] is None and r["host"].startswith("www.site")]
    blocked = [r for r in made if r["verdict"] == "block"]
    assert blocked and all("/bad/" in r["path"] for r in blocked)


def test_urls_without_rows_or_labels(spark, judged):
    _, _, pages, known = judged
    assert urls.filter_urls(pages.where("false"), known, RULES).count() == 0
    rows = urls.filter_urls(pages, known.where("false"), RULES)
    assert rows.where("rule IS NULL AND verdict <> 'allow'").count() == 0 and rows.count() == pages.count()


def test_urls_without_labels_join_no_others(spark):
    parts = {"good": 0, "new": None, "bad": 1}
    places = [(f"/{part}/{i}", bad) for part, bad in parts.items() for i in range(40)]
    pages = spark.createDataFrame([(f"x://h{p}",) for p, _ in places], "url string").withColumn("page_id", F.col("url"))
    known = spark.createDataFrame([("h", p, b) for p, b in places if b is not None], "host string, path string, bad int")
    got = {r["path"]: r for r in urls.filter_urls(pages, known, []).collect()}
    assert all(got[p]["verdict"] == ("block" if b else "allow") for p, b in places if b is not None)
    assert {got[p]["template"] for p, b in places if b is None} == {"/new/*"}
    assert all(got[p]["purity"] == pytest.approx(0.5) for p, b in places if b is None)


def test_urls_keep_small_sections_of_large_nodes(spark):
    """60 equal sections, under 2% each, and ids that occur once: the one bad section is found."""
    places = [(f"/s{k}/{i}", int(k == 7)) for k in range(60) for i in range(12)] + [(f"/{10**6 + i}", 0) for i in range(40)]
    pages = spark.createDataFrame([(f"x://h{p}",) for p, _ in places], "url string").withColumn("page_id", F.col("url"))
    known = spark.createDataFrame([("h", p, b) for p, b in places], "host string, path string, bad int")
    got = {r["path"]: r for r in urls.filter_urls(pages, known, []).collect()}
    assert len(got) == len(places)
    assert all(got[p]["verdict"] == ("block" if b else "allow") for p, b in places)
    assert {got[p]["template"] for p, b in places if b} == {"/s7/*"}
    assert {got[p]["template"].split("/")[1] for p, b in places if not b} == {"*|%+59"}


def test_urls_do_not_merge_by_chaining(spark):
    """21 sections whose share of bad pages grows by five in a hundred from one to the next."""
    places = [(f"/s{k:02}/{i}", int(i < 2 * k)) for k in range(21) for i in range(40)]
    pages = spark.createDataFrame([(f"x://h{p}",) for p, _ in places], "url string").withColumn("page_id", F.col("url"))
    known = spark.createDataFrame([("h", p, b) for p, b in places], "host string, path string, bad int")
    got = {r["path"]: r for r in urls.filter_urls(pages, known, []).collect()}
    assert len({r["template"] for r in got.values()}) >= 3
    assert {r["verdict"] for p, r in got.items() if p.startswith("/s00/")} == {"allow"}
    assert {r["verdict"] for p, r in got.items() if p.startswith("/s20/")} == {"block"}
    trees = brute.templates([("h", p, b) for p, b in places])
    assert all((r["template"], r["purity"]) == (trees["h", p][0], pytest.approx(trees["h", p][1])) for p, r in got.items())


def test_urls_of_weak_sections_stay_apart_and_deep_ones_are_generalised(spark):
    deep = "/".join("d" * 12)
    places = [(f"/w{k}/{i}", 1 if i < 2 else None) for k in range(6) for i in range(9)]
    places += [(f"/{deep}/{part}/{i}", int(part == "bad")) for part in ("bad", "good") for i in range(30)]
    pages = spark.createDataFrame([(f"x://h{p}",) for p, _ in places], "url string").withColumn("page_id", F.col("url"))
    known = spark.createDataFrame([("h", p, b) for p, b in places if b is not None], "host string, path string, bad int")
    got = {r["path"]: r for r in urls.filter_urls(pages, known, []).collect()}
    assert {got[p]["template"] for p, _ in places[:54]} == {f"/w{k}/*" for k in range(6)}
    assert all(got[p]["verdict"] == ("block" if b else "allow") for p, b in places[54:])
    assert {got[p]["template"] for p, b in places[54:] if b} == {f"/{deep}/bad/*"}


def test_urls_of_one_page_and_a_hot_path(spark):
    """A third of all pages are one url; a host has a single page; clashing names are no matter."""
    rows = [(i, "x://h/a", "n") for i in range(100)] + [(100 + i, f"x://h/b/{i}", "n") for i in range(199)] + [(None, "x://one/long/path", None)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, place string")
    known = spark.createDataFrame([("h", "/a", 1)] + [("h", f"/b/{i}", 0) for i in range(150)], "host string, path string, bad int")
    got = urls.filter_urls(pages, known, []).collect()
    assert len(got) == 300 and sum(r["verdict"] == "block" for r in got) == 100
    assert [r["template"] for r in got if r["page_id"] is None] == [""]

NASTY = ["", "a", "<|im_end|>", r"<\|", r"<\\|x<|<\|", "<<||>>|<", "line\nbreak", "%0A%25", "<|image|>", "é😀", "\\", "|", "<"]


def test_escape_is_reversible(spark):
    random_ = random.Random(2)
    texts = NASTY + ["".join(random_.choice("<|\\a>") for _ in range(random_.randint(0, 12))) for _ in range(500)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("e", chat.escape(F.col("t")))
    rows = rows.withColumn("back", chat.unescape(F.col("e"))).collect()
    assert all(r["back"] == r["t"] and "<|" not in r["e"] for r in rows)
    assert len({r["e"] for r in rows}) == len({r["t"] for r in rows})


def test_turns_round_trip(spark):
    rows = [(i, role, text) for i, (role, text) in enumerate((a, b) for a in [*NASTY, "assistant"] for b in NASTY)]
    rows += [(9000, None, "x"), (9001, "assistant", None), (9002, None, None)]
    turns = spark.createDataFrame(rows, "turn int, role string, text string")
    turns = turns.withColumn("content", chat.text_part(F.col("text")))
    out = chat.format_turns(turns)
    role, text = chat.read_turn(F.col("formatted"))
    loss = chat.read_loss(F.col("formatted"), F.col("loss_start"), F.col("loss_chars"))
    for r in out.select("*", role.alias("r"), text.alias("t"), loss.alias("l")).collect():
        assert (r["r"], r["t"]) == (r["role"] or "", r["text"] or "")
        assert r["l"] == ((r["text"] or "") if r["role"] == "assistant" else "")
        assert r["formatted"].count("<|") == 2 and r["expanded_tokens"] == 0 and r["attachments"] == []


def test_typed_parts(spark):
    def part(kind, text=None, ref=None, width=None, height=None, seconds=None, pages=None):
        return (kind, text, ref, width, height, seconds, pages)

    content = [
        part("text", "see <|image|> "), part("image", None, "a.png", 57, 28), part("audio", None, "b.wav", seconds=1.5),
        part("document", None, "c.pdf", pages=3), part("image", None, None), part(None, "end"), part("other", None),
    ]
    turns = spark.createDataFrame([(1, "user", content), (2, "user", []), (3, "user", None)], f"id int, role string, content array<{chat.PART}>")
    got = {r["id"]: r for r in chat.format_turns(turns).collect()}
    text = got[1]["formatted"]
    assert text == "<|im_start|>user\nsee <\\|image|> <|image|><|audio|><|document|><|image|>end<|im_end|>\n"
    marks = [(a["index"], a["type"], a["ref"], a["tokens"]) for a in got[1]["attachments"]]
    assert marks == [(1, "image", "a.png", 3), (2, "audio", "b.wav", 38), (3, "document", "c.pdf", 1536), (4, "image", None, 1)]
    for a in got[1]["attachments"]:
        assert text[a["position"] :].startswith(chat.PLACEHOLDERS[a["type"]])
    assert got[1]["expanded_tokens"] == 3 + 38 + 1536 + 1
    assert got[2]["formatted"] == got[3]["formatted"] == "<|im_start|>user\n<|im_end|>\n"


def audited(spark, kept, other):
    schema = "file bigint, offset bigint, record binary"
    rows = warc.audit(spark.createDataFrame(kept, schema), spark.createDataFrame(other, schema)).collect()
    return sorted((r["file"], r["offset"], r["status"]) for r in rows)


def test_warc_audit(spark):
    random_ = random.Random(6)
    kept, at = [], defaultdict(int)
    for _ in range(3000):
        file, data = random_.randrange(3), bytes(random_.randrange(256) for _ in range(random_.randint(0, 3000)))
        kept.append((file, at[file], data))
        at[file] += len(data) + 100
    other, want = [], []
    for file, offset, data in kept:
        kind = random_.random()
        if kind < 0.005:
            want.append((file, offset, "missing"))
        elif kind < 0.01 and data:
            want.append((file, offset, "corrupt"))
            other.append((file, offset, data[:-1] + bytes([data[-1] ^ 1])))
        else:
            other.append((file, offset, data))
    other.append((7, 0, b"new"))
    want.append((7, 0, "extra"))
    assert audited(spark, kept, other) == sorted(want) and len(want) > 10
    assert audited(spark, kept, kept) == []
    assert audited(spark, kept[:5], []) == sorted((f, o, "missing") for f, o, _ in kept[:5])
    assert audited(spark, [], []) == []
    twice = [(0, 0, b"a"), (0, 0, b"b"), (None, None, None)]
    assert audited(spark, twice, twice[::-1]) == []
    assert audited(spark, twice, twice[:1]) == [(0, 0, "corrupt")]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    long = next(r[1] for r in awkward() if len(brute.words(r[1])) >= 30)
    spark.createDataFrame([(1, long), (2, None)], "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages_on_awkward_rows(spark, folder):
    rows = awkward() + awkward()[:30] + [(None, " ".join(f"w{i}" for i in range(50)), None, None, None, "x", "y", 1)] * 2
    docs = spark.createDataFrame(rows, DOCS)
    assert len(corpus_pipeline.STAGES) == 5
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.collect()
        docs = stage(spark, docs, folder).cache()
        after = docs.collect()
        assert set(docs.columns) == {"doc_id", "text", "lang", "source", "n_chars", "kept", "shard", "a.b"} | (
            {"slot"} if number == 4 else set()
        )
        if number == 0:
            good = lambda t: (lambda q: q["n_words"] >= 20 and 100 * q["n_repeat_words"] <= 30 * q["n_words"])(brute.quality(t))
            assert all(good(r["text"]) for r in after) and 0 < len(after) < len(before)
        if number == 1:
            want = brute.components(sorted({(r["doc_id"], r["text"]) for r in before if r["doc_id"] is not None}), 5)
            assert sorted(r["doc_id"] for r in after if r["doc_id"] is not None) == sorted(i for i, c in want.items() if i == c)
            assert sum(r["doc_id"] is None for r in after) == 2
        if number == 2:
            wins = brute.windows([(r["item_id"], r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()])
            clean = [r for r in before if not brute.hits(r["text"], wins)[1]]
            texts = lambda rows: sorted((str(r["doc_id"]), r["text"], str(r["source"]), r["a.b"]) for r in rows)
            assert texts(after) == texts(clean) and len(clean) < len(before)
        if number == 3:
            whole = {r["doc_id"]: r["text"] for r in before}
            assert all(r["n_chars"] == len(r["text"]) for r in after)
            assert {r["doc_id"] for r in after} <= set(whole) and len(after) >= len(before)
        if number == 4:
            assert len(after) == len(before)
            slots = defaultdict(list)
            for r in after:
                slots[r["shard"]].append(r["slot"])
            assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_stages_on_no_rows(spark, folder):
    docs = spark.createDataFrame([], DOCS)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        assert docs.count() == 0


def test_run_is_the_stages(spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert {"doc_id", "text", "shard", "slot"} <= set(rows.columns) and rows.count() > 0


def test_digest_of_a_conversation(spark):
    from winnowmill.llm.queries_chat import INJECTION, op9_chat_formatting

    row = op9_chat_formatting(spark, "/root/testdata/sf0.001").where("conv_id = -1").first()
    said = f"user\n{INJECTION}\nassistant\n{INJECTION}\n"
    assert row["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest()
    assert row["loss_sha256"] == hashlib.sha256(INJECTION.encode()).hexdigest() and row["loss_chars"] == len(INJECTION)


def test_near_stage_of_the_pipeline_tells_rows_of_one_id_apart(spark):
    """Repeated ids, and columns with the names that the operators use."""
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(1, "one thing here", "a"), (1, "something quite different", "b"), (2, "and a third text", "c")]
    rows += [(3, long, "d"), (3, long + " more", "e"), (4, long, "f"), (None, long, "g"), (5, None, "h"), (5, None, "i"), (6, long, "j"), (6, "own words", "k")]
    schema = "doc_id bigint, text string, __h string"
    docs = spark.createDataFrame(rows, schema)
    names = {"__word": F.lit(1), "__bit": F.lit(2), "maybe": F.lit(3), "row": F.lit(4), "a.b": F.lit(5), "kept": F.lit(6)}
    docs = docs.withColumns(names)
    got = corpus_pipeline.near_copies(spark, docs, "/nowhere")
    assert got.columns == docs.columns
    left = sorted(r["__h"] for r in got.collect())
    assert [x for x in left if x not in "de"] == ["a", "b", "c", "g", "h", "i", "k"] and sum(x in "de" for x in left) == 1
