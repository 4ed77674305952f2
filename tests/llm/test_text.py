"""Quality rules, classifier, pieces, WARC derivatives, license scan and the pipeline."""

import gzip
import heapq
import json
import random
import zlib

import brute
import numpy as np
import pyarrow as pa
import pytest
from llm_data import docs, nothing, rows  # noqa: F401
from llm_same import same

from clickscore.llm import licenses, pieces, quality_model, quality_rules, warc
from clickscore.llm.queries import PIECE_MODEL

SMALL = "/root/testdata/sf0.001"
STATS = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_quality_statistics(docs, rows):
    same(quality_rules.op5(docs), [(d, *brute.statistics(t)) for d, t in rows], STATS)


def test_quality_verdict_is_a_robust_distance(spark):
    """The verdict follows a plain search for the half with the smallest determinant."""
    rng = np.random.default_rng(1)
    rows = []
    for i in range(400):
        n = int(rng.integers(60, 300))
        words = ["".join(rng.choice(list("abcdefgh"), rng.integers(3, 8))) for _ in range(n)]
        if i % 40 == 0:
            words = [w + "|#%" for w in words]
        rows.append((i, " ".join(words), "en", "s" if i % 3 else "t"))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    got = {r.doc_id: r for r in quality_rules.judge(docs).collect()}
    assert [i for i in got if not got[i].kept] == [i for i in got if i % 40 == 0]
    for source in "st":
        own = [r for r in rows if r[3] == source]
        x = np.array([plain_vector(r[1]) for r in own])
        d2 = plain_mcd(x)
        score = np.array([got[r[0]].outlier_score for r in own])
        assert np.allclose(score, d2, rtol=0.25)


def plain_vector(text):
    words = text.split()
    chars = sum(map(len, words))
    n, _, symbols, dup, again, _ = brute.statistics(text)
    loud = sum(c.isupper() or c == "!" for c in text)
    return [np.log1p(n), chars / n, (symbols / chars) ** 0.5, dup**0.5, (again / n) ** 0.5, (loud / chars) ** 0.5]


# Spreads that are never surprising, and the median of chi-square with 6 degrees.
SPREADS = [1.0, 0.4, 0.04, 0.3, 0.3, 0.1]
MEDIAN = 5.348


def plain_mcd(x, tries=60):
    """Scaled distances under the half with the smallest determinant that many random starts find."""
    floor = np.diag(np.square(SPREADS))
    rng = np.random.default_rng(8)
    half = (len(x) + 1) // 2

    def distance(sub):
        cov = np.cov(sub.T, bias=True) + floor
        e = x - sub.mean(axis=0)
        return np.einsum("ij,jk,ik->i", e, np.linalg.inv(cov), e), np.linalg.slogdet(cov)[1]

    best = (np.inf, None)
    for _ in range(tries):
        d, det = distance(x[rng.choice(len(x), 8, replace=False)])
        for _ in range(30):
            d, new = distance(x[np.argsort(d, kind="stable")[:half]])
            if new >= det - 1e-12 and _ > 1:
                break
            det = new
        if det < best[0]:
            best = (det, d)
    d = best[1]
    return d * MEDIAN / np.sort(d)[half - 1]


@pytest.mark.parametrize("share", [0.1, 0.3, 0.45])
def test_clustered_outliers_do_not_move_the_estimates(spark, share):
    rng = np.random.default_rng(int(share * 100))
    rows, out = [], []
    for g, n in (("a", 400), ("b", 90)):
        centre, spread = np.array([5.5, 5.0, 0.02, 0.1, 0.1, 0.2]), np.array([0.6, 0.3, 0.02, 0.1, 0.1, 0.05])
        x = centre + rng.normal(size=(n, 6)) * spread
        bad = np.arange(n) < share * n
        x[bad] = centre + [6, 14, 1.4, 4, 4, 2] + rng.normal(size=(bad.sum(), 6)) * spread * 0.3
        rows += [(g, *map(float, v)) for v in x]
        out.append((g, x, bad))
    df = spark.createDataFrame(rows, ["grp", *quality_rules.NAMES]).repartition(3)
    est = quality_rules.estimates(df)
    scored = quality_rules.with_distance(df, est.drop("half_bin", "mid"), ["grp"]).join(est.select("grp", "mid"), "grp")
    got = [(r["grp"], r["d2"] * quality_rules.CHI2_MEDIAN / r["mid"], r[quality_rules.NAMES[0]]) for r in scored.collect()]
    for g, x, bad in out:
        mine = {v: s for h, s, v in got if h == g}
        score = np.array([mine[v] for v in x[:, 0]])
        assert (score[bad] > quality_rules.CUTOFF).all() and (score[~bad] < quality_rules.CUTOFF).all()
        # The plain version cuts the half exactly, the operator by bins of distance.
        assert np.allclose(score, plain_mcd(x), rtol=0.25)


def test_ties_repeated_rows_and_small_groups(spark):
    rng = np.random.default_rng(5)
    word = lambda k: "".join(rng.choice(list("abcdefgh"), k))
    text = " ".join(word(5) for _ in range(80))
    rows = [(i, text, "en", "same") for i in range(120)]  # no spread at all
    rows += [(200 + i, " ".join(word(4 + i % 3) for _ in range(70 + i)), "de", f"small{i}") for i in range(60)]
    rows += [(300 + i, " ".join(word(5) for _ in range(60)), None, None) for i in range(10)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    got = {r.doc_id: r for r in quality_rules.judge(docs).collect()}
    assert len(got) == len(rows) and all(r.kept for r in got.values())
    assert len({got[i].outlier_score for i in range(120)}) == 1
    assert all(got[200 + i].outlier_score is not None for i in range(60))  # the language's small sources together


def test_quality_rules_use_no_python(docs):
    plan = quality_rules.statistics(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    whole = quality_rules.judge(docs)._jdf.queryExecution().toString()
    assert "Python" not in whole and "Arrow" not in whole and "Pandas" not in whole


def test_quality_of_few_or_no_rows(nothing, docs):
    assert quality_rules.op5(nothing).count() == 0
    few = docs.filter("doc_id in (5, 11)")
    assert {(r.doc_id, r.kept) for r in quality_rules.op5(few).collect()} == {(5, True), (11, True)}


def test_classifier_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/../sf0.01/{t}.parquet") for t in ("documents", "labels"))
    found = quality_model.op8(docs, labels)
    assert found.count() == docs.count()
    rows = found.join(labels, "doc_id").filter("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.93
    assert all(0 <= r.score <= 1 for r in rows)


def test_classifier_odd_rows(spark, docs, rows, nothing):
    labels = spark.createDataFrame([(5, 1), (11, 0), (None, 1), (6, None), (16, 0)], "doc_id bigint, quality int")
    found = quality_model.op8(docs, labels).collect()
    assert len(found) == len(rows) and all(r.score is not None for r in found)
    none = labels.filter("doc_id < -1")
    assert quality_model.op8(docs, none).filter("score is null").count() == 0
    assert quality_model.op8(nothing, none).count() == 0


def test_classifier_sees_no_held_out_label(spark, docs):
    ids = [r[0] for r in docs.select("doc_id").where("doc_id is not null").distinct().collect()]
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id bigint, quality int")
    held = quality_model.held_out(labels["doc_id"])
    one, two = quality_model.train(docs, labels), quality_model.train(docs, labels.filter(~held))
    assert np.array_equal(one.vectors, two.vectors)


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.load_vocabulary(PIECE_MODEL)


def test_pieces_round_trip(docs, rows):
    found = pieces.op6(docs, PIECE_MODEL)
    same(found, [(d, brute.sha(t or ""), True) for d, t in rows], ["doc_id", "decoded_sha256", "round_trip"])


def test_pieces_empty(nothing):
    assert pieces.op6(nothing, PIECE_MODEL).count() == 0


def plain_n_best(text, voc, scores, n):
    """All segmentations of a short text, best scores first."""
    marked = "▁" + text.replace(" ", "▁")
    best = [[] for _ in range(len(marked) + 1)]
    best[0] = [0.0]
    for end in range(1, len(marked) + 1):
        found = []
        for begin in range(max(0, end - voc.longest), end):
            score = scores.get(marked[begin:end], voc.unknown if end - begin == 1 else None)
            if score is not None:
                found += [x + score for x in best[begin]]
        best[end] = heapq.nlargest(n, found)
    return best[-1]


def test_n_best_segmentations(vocabulary):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    scores = {
        model.id_to_piece(i): model.get_score(i)
        for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))
    }
    rng = random.Random(2)
    texts = ["".join(rng.choice("aeilnorst the.") for _ in range(rng.randint(1, 25))) for _ in range(80)]
    texts = [t for t in texts if t] + ["aaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "    ", "日本語", "a"]
    batch = pa.record_batch({"doc_id": list(range(len(texts))), "row_hash": [0] * len(texts), "text": texts})
    for made in pieces.encode_batches(iter([batch]), vocabulary, 4):
        for text, row in zip(texts, made.to_pylist()):
            want = plain_n_best(text, vocabulary, scores, 4)
            assert np.allclose([x["score"] for x in row["n_best"]], want), text
            seen = set()
            for x in row["n_best"]:
                ids = list(row["ids"])
                for s in reversed(x["swaps"]):
                    ids[s["at"] : s["at"] + s["removed"]] = s["ids"]
                assert len(ids) == x["n_pieces"] and tuple(ids) not in seen
                seen.add(tuple(ids))
                assert b"".join(vocabulary.texts[i] for i in ids).decode() == " " + text


PAGES = [
    (1, "http://a.example/x", "<html lang=\"en\"><head><title>A &amp; B</title><script>no()</script></head><body><p>One<br>two</p><a href='/l'>x</a></body>"),
    (2, None, None), (3, "", ""), (4, "http://b.example/é", "plain <b>text</b> &lt;kept&gt; 5 < 6 > 4"), (4, "http://b.example/é", "plain <b>text</b> &lt;kept&gt; 5 < 6 > 4"),
    (None, "http://c.example", "<p>" + "long words " * 50000 + "</p>"), (5, "http://d.example", "<script>never closed"),
]


def test_warc_derivatives(spark):
    pages = spark.createDataFrame([(*p, "x", "y") for p in PAGES], "page_id bigint, url string, html string, block string, record string")
    responses = {r.record_id: r for r in warc.responses_of(pages).collect()}
    found = warc.op7(pages).collect()
    assert len(found) == 2 * len(PAGES)
    for r in found:
        ((head, block),) = warc.parse_records(bytes(r.record))
        source = responses[r.refers_to]
        assert head["WARC-Refers-To"] == r.refers_to and head["WARC-Record-ID"] == r.record_id != r.refers_to
        assert head["WARC-Target-URI"] == source.target_uri and head["WARC-Type"] == r.record_type
        assert head["WARC-Block-Digest"] == warc.digest(block) == r.block_digest and len(block) == r.content_length
        if r.record_type == "metadata":
            about = json.loads(block)
            assert about["block_digest_valid"] and about["payload_digest_valid"]
            assert about["payload_digest"] == source.payload_digest
            assert ["Content-Type", "text/html; charset=utf-8"] in about["http_headers"]
    text = {r.page_id: bytes(r.record).partition(b"\r\n\r\n")[2][:-4].decode() for r in found if r.record_type == "conversion"}
    assert text[1] == "A & B\nOne\ntwo\nx" and text[4] == "plain text <kept> 5 < 6 > 4" and text[2] == text[5] == ""
    assert text[None] == ("long words " * 50000).strip()
    assert warc.op7(pages.filter("page_id < 0")).count() == 0


def test_warc_digest_mismatch_is_kept_and_marked():
    source = {
        "record_id": "<urn:x>", "target_uri": "u", "date": "d", "block": b"HTTP/1.1 200 OK\r\nA: b\r\n\r\n<p>hi",
        "block_digest": "sha1:WRONG", "payload_digest": "sha1:WRONG",
    }
    about = json.loads(warc.parse_records(warc.derive(source)[0][-1])[0][1])
    assert about["payload_digest"] == "sha1:WRONG" and not about["payload_digest_valid"] and not about["block_digest_valid"]


def test_warc_files(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, "page_id bigint, url string, html string")
    warc.write_files(warc.op7(pages), str(tmp_path / "out"))
    members = [bytes(r.member) for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    data = gzip.decompress(b"".join(members))
    assert len(warc.parse_records(data)) == 2 * len(PAGES) and zlib.crc32(data)


def plain_licenses(text):
    """Templates whose shingles some stretch of a window's length holds to 80 per cent."""
    words = brute.LETTERS.findall((text or "").translate(brute.LOW))
    found = set()
    for name, template in licenses.TEMPLATES.items():
        t = brute.LETTERS.findall(template.translate(brute.LOW))
        wanted = {tuple(t[i : i + 5]) for i in range(len(t) - 4)}
        power = max(len(t) - 5, 0).bit_length()
        size = 2 << power if power else 1
        for i in range(len(words) - 4):
            own = {tuple(words[j : j + 5]) for j in range(i, min(i + size, len(words) - 4))}
            if len(own & wanted) >= 0.8 * len(wanted):
                found.add(name)
                break
    return found


def test_license_scan(spark, rows):
    rng = random.Random(4)
    filler = lambda n: " ".join("".join(rng.choice("abcdefg") for _ in range(5)) for _ in range(n))
    texts = [f"{filler(rng.randint(0, 90))} {t} {filler(rng.randint(0, 90))}" for t in licenses.TEMPLATES.values() for _ in range(4)]
    long = licenses.TEMPLATES["MIT"].split()
    texts += [" ".join(long[: len(long) // 2]), " ".join(long[:-6]), " ".join(long[:20] + ["odd"] + long[21:])]
    texts += [filler(50), None, "", "a b c", "Released under the MIT Licence.", *[t for _, t in rows if t and len(t) < 9000]]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id bigint, text string, matches string")
    found = {r.doc_id: set(filter(None, r.licenses.split(","))) for r in licenses.op10(docs).collect()}
    assert found == {i: plain_licenses(t) for i, t in enumerate(texts)}
    assert licenses.op10(docs.filter("doc_id < 0")).count() == 0


def test_stretched_notices_are_found_at_every_offset():
    """Thirty words put into the long notice, in one place, with any number of words before it."""
    rng = random.Random(9)
    filler = lambda n: " ".join("".join(rng.choice("abcdefg") for _ in range(5)) for _ in range(n))
    own = licenses.TEMPLATES["MIT"].split()
    scales = licenses.build_scales(licenses.TEMPLATES)
    texts = [f"{filler(i)} {' '.join(own[:31])} {filler(30)} {' '.join(own[31:])} {filler(40)}" for i in range(130)]
    batch = pa.record_batch({"doc_id": list(range(130)), "text": texts})
    (made,) = licenses.scan_batches(iter([batch]), scales)
    found = [[m["template"] for m in r["matches"]] for r in made.to_pylist()]
    assert found == [["MIT"]] * 130


def test_license_templates_from_a_table(spark):
    table = spark.createDataFrame(
        [("A", "one two three four five six seven"), ("A", "zzz"), (None, "x"), ("B", None), ("C", "too short")], "name string, text string"
    )
    docs = spark.createDataFrame([(1, "so one two three four five six seven it is"), (2, None)], "doc_id bigint, text string")
    got = {r.doc_id: [m["template"] for m in r.matches] for r in licenses.scan(docs, table).collect()}
    assert got == {1: ["A"], 2: []}
    with pytest.raises(ValueError):
        licenses.template_texts(table, 10)


def test_best_stretch():
    places, values = np.array([0, 1, 5, 6, 7, 20]), np.array([1, 2, 1, 3, 2, 9])
    assert licenses.best_stretch(places, values, 8) == (3, 1, 7)
    assert licenses.best_stretch(places, values, 1) == (1, 0, 1)
    assert licenses.best_stretch(places[:0], values[:0], 4) == (0, 0, 0)


def test_license_bands_guarantee():
    for scale in licenses.build_scales(licenses.TEMPLATES):
        for _, hashes, words in scale.templates:
            assert words - 4 <= scale.stride
            need = -(-4 * len(hashes) // 5)
            need = -(-need // 2) if scale.window > 1 else need
            low = need / (scale.window + len(hashes) - need)
            assert (1 - min(low, 1)) ** len(scale.seeds) <= licenses.MISS


def test_pipeline_stages(spark, tmp_path):
    """Every stage against a plain version of what it has to do with its own input."""
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    spark.read.parquet(f"{SMALL}/benchmark.parquet")
    for name, stage in p.STAGES:
        before = [(r.doc_id, r.text) for r in docs.collect()]
        out = stage(spark, docs, SMALL)
        out.write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        if name != p.STAGES[-1][0]:
            assert sorted(out.columns) == sorted(docs.columns)
        after = {r.doc_id: r for r in out.collect()}
        if name == "quality_rules":
            failed = {d for d, t in before if brute.statistics(t)[-1]}
            assert not failed & set(after) and len(after) > 0.6 * len(before)
        elif name == "line_dedup":
            assert {d: brute.sha(r.text) for d, r in after.items()} == {x[0]: x[3] for x in brute.line_dedup(before)}
            assert all(r.n_chars == len(r.text) for r in after.values())
        elif name == "near_copies":
            assert set(after) == {x[0] for x in brute.jaccard(before) if x[0] == x[2]}
        elif name == "decontamination":
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
            assert set(after) == {x[0] for x in brute.decontamination(before, items) if not x[5]}
        else:
            assert set(after) == {d for d, _ in before} and all(r.round_trip for r in after.values())
        docs = out
    assert p.run(spark, SMALL).count() == docs.count()


@pytest.mark.parametrize("piece", ["=", "ab", "-=", "x y"])
def test_pieces_of_long_runs_without_a_cut(vocabulary, piece):
    """Time and memory grow with the run, and the best paths are those of the plain search on a short one."""
    import resource
    import time

    text = piece * (40_000 // len(piece))
    batch = pa.record_batch({"doc_id": [1], "row_hash": [0], "text": [text]})
    before, t0 = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss, time.time()
    (made,) = pieces.encode_batches(iter([batch]), vocabulary, 3)
    assert time.time() - t0 < 12
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 400 << 10
    (row,) = made.to_pylist()
    assert b"".join(vocabulary.texts[i] for i in row["ids"]).decode() == " " + text
    scores = [x["score"] for x in row["n_best"]]
    assert len(scores) == 3 and scores == sorted(scores, reverse=True)


@pytest.mark.parametrize("mark", ["<!--", "<noscript>", "<template ", "<script>", "<a ", "<title>", "<p ", "<html ", "<a href='", "</title"])
def test_warc_unclosed_markup_takes_time_in_proportion(mark):
    import time

    payload = (mark * (1_000_000 // len(mark))).encode()
    t0 = time.time()
    warc.derive({
        "record_id": "<urn:x>", "target_uri": "u", "date": "d", "block": b"HTTP/1.1 200 OK\r\n\r\n" + payload,
        "block_digest": "", "payload_digest": "",
    })
    assert time.time() - t0 < 2


def test_warc_hidden_parts():
    assert warc.plain_text("a<!-- b -->c<SCRIPT x>d</script >e<style>f</style>g<scripted>h") == "a c e gh"
    assert warc.plain_text("a<!-- b <p>c") == "a<!-- b\nc"
    assert warc.plain_text("a<noscript>b") == "ab" and warc.plain_text("a<script>b <p>c") == "a"
    assert warc.plain_text("x<template>y<!--</template>z-->w") == "x z-->w"


@pytest.mark.parametrize("coding, pack", [
    ("", lambda b: b), ("gzip", gzip.compress), ("deflate", zlib.compress), ("x-gzip", gzip.compress), ("deflate, gzip", lambda b: gzip.compress(zlib.compress(b))),
])
@pytest.mark.parametrize("chunked", [False, True])
@pytest.mark.parametrize("charset", ["utf-8", "iso-8859-1", "shift_jis"])
def test_warc_bodies_are_decoded(coding, pack, chunked, charset):
    words = {"utf-8": "é 日本", "iso-8859-1": "é ß", "shift_jis": "日本"}[charset]
    body = pack(f"<title>{words}</title><p>{words}</p><a href='/é'>x</a>".encode(charset, "replace"))
    if chunked:
        body = b"".join(b"%x;n=1\r\n%s\r\n" % (len(body[i : i + 7]), body[i : i + 7]) for i in range(0, len(body), 7)) + b"0\r\n\r\n"
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset={charset}\r\nContent-Encoding: {coding}\r\n" + ("Transfer-Encoding: chunked\r\n" if chunked else "")
    block = head.encode() + b"\r\n" + body
    source = {"record_id": "<urn:x>", "target_uri": "u", "date": "d", "block": block, "block_digest": warc.digest(block), "payload_digest": warc.digest(body)}
    about, text = (warc.parse_records(r[-1])[0][1].decode() for r in warc.derive(source))
    about = json.loads(about)
    assert text.startswith(f"{words}\n{words}") and about["title"] == words
    assert about["payload_digest_valid"] and about["block_digest_valid"] and "not_decoded" not in about


def test_warc_names_what_it_cannot_decode():
    def about(headers, body):
        block = b"HTTP/1.1 200 OK\r\n" + headers + b"\r\n\r\n" + body
        return json.loads(warc.parse_records(warc.derive({
            "record_id": "<urn:x>", "target_uri": "u", "date": "d", "block": block, "block_digest": "", "payload_digest": "",
        })[0][-1])[0][1])

    assert about(b"Content-Encoding: br", b"\x01\x02")["not_decoded"] == ["br"]
    assert about(b"Content-Encoding: gzip", b"broken")["not_decoded"] == ["gzip"]
    assert about(b"Transfer-Encoding: chunked", b"zz\r\n")["not_decoded"] == ["chunked"]
    assert about(b"Content-Type: text/html; charset=none-such", b"<p>hi")["not_decoded"] == ["charset none-such"]
    assert about(b"A: b", "<meta charset='iso-8859-1'><title>é</title>".encode("iso-8859-1"))["title"] == "é"
