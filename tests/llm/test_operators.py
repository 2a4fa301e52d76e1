"""The operators against brute force on awkward rows and on the smallest tables."""
from __future__ import annotations

import hashlib
import random
import re
import time

from collections import Counter


import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from auric.llm import (decontam, html_extract, jaccard_join, langid, licenses, mixing, quality_classifier, quality_rules,
                       suffix_dedup, tokens)
from auric.llm.textbatch import saved, table, written
from tools.oracle_check import TABLES, digest


from .conftest import AWKWARD, rows

SMALL = "/root/testdata/sf0.001"
MODEL = public_tokenizers.path("piece_bpe_32k.model")
AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def small_documents():
    return duckdb.sql(f"SELECT doc_id, text, lang, source FROM '{SMALL}/documents.parquet'").fetchall()


def lower_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(AZ))


def plain_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# --- 1 language -----------------------------------------------------------

def test_language_held_out_accuracy(spark):
    docs = table(spark, SMALL, "documents")
    model = langid.fit(docs)
    got = langid.identify(docs, model).select("lang", "lang_pred", "score", langid.held_out(F.col("doc_id")).alias("h")).collect()
    held = [r for r in got if r["h"]]
    assert held and sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.95
    assert all(0 <= r["score"] <= 1 for r in got)


def test_language_awkward(spark, awkward, nothing):
    docs = table(spark, SMALL, "documents")
    model = langid.fit(docs)
    got = langid.identify(awkward.drop("score"), model, keep=["doc_id", "text"]).collect()
    assert len(got) == len(AWKWARD)
    for r in got:
        letter = bool(r["text"]) and any(c.isalpha() for c in r["text"])
        assert (r["lang_pred"] == "und") == (not letter)
    assert langid.fit(nothing).langs == []
    assert langid.identify(nothing, model, keep=["doc_id"]).count() == 0
    assert {r["lang_pred"] for r in langid.identify(awkward, langid.fit(nothing), keep=["doc_id"]).collect()} == {"und"}


def test_language_never_reads_held_out_rows(spark):
    docs = table(spark, SMALL, "documents")
    changed = docs.withColumn("lang", F.when(langid.held_out(F.col("doc_id")), F.lit("xx")).otherwise(F.col("lang")))
    a, b = langid.fit(docs), langid.fit(changed)
    assert a.langs == b.langs and np.allclose(a.weights, b.weights)


# --- 2 tokens -------------------------------------------------------------

def test_tokens(awkward, nothing):
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    got = rows(tokens.count_tokens(awkward, MODEL))
    want = [(i, len((t or "").encode()), len(model.encode(t or "")), len(model.encode(t or "")) > 4096) for i, t, _, _ in AWKWARD]
    assert got == sorted(want, key=lambda r: tuple((x is None, x) for x in r))
    assert tokens.count_tokens(nothing, MODEL).count() == 0


@pytest.mark.parametrize("least", [1, 3, 50])
def test_split_texts_have_the_same_tokens(least):
    model, split = tokens._load(MODEL)
    assert split
    for text in ["  a  b c  ", "a▁b c d", "x\n y z", "<s> hi </s> <unk> a", "tab\tx y", "a ▁b", "é è ü 漢 字 🙂 b"] + [t for _, t, _, _ in small_documents()[:30]]:
        assert sum(len(model.encode(p)) for p in tokens.pieces(text, least)) == len(model.encode(text))


# --- 3 licences -----------------------------------------------------------

def brute_licence(text):
    w, starts, labels = lower_words(text), [], set()
    for label, phrase in licenses.BASE:
        p = phrase.split()
        for k in range(len(w) - len(p) + 1):
            if w[k:k + len(p)] == p:
                starts.append(k)
                labels.add(label)
    return len(w), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def test_licences(spark, awkward, nothing):
    columns = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"]
    assert rows(licenses.scan(awkward).select(*columns)) == sorted(
        [(i, *brute_licence(t)) for i, t, _, _ in AWKWARD], key=lambda r: tuple((x is None, x) for x in r))
    got = rows(licenses.scan(table(spark, SMALL, "documents")).select(*columns))
    assert got == sorted([(i, *brute_licence(t)) for i, t, _, _ in small_documents()], key=lambda r: tuple((x is None, x) for x in r))
    assert licenses.scan(nothing).count() == 0


def test_longer_notices(spark):
    mit = next(t for label, t, _ in licenses.NOTICES if label == "mit")
    texts = [(1, "Copyright. " + mit.upper() + " etc."), (2, mit.replace("hereby granted", "granted")),
             (3, mit.replace("associated documentation", "related docs")), (4, "nothing of the kind")]
    got = {r["doc_id"]: (r["base_labels"], r["labels"], r["score"]) for r in licenses.scan(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert got[1] == ("", "mit", 1.0) and got[2] == ("", "", 0.0) and got[4] == ("", "", 0.0)
    assert got[3][1] == "mit" and 0.8 <= got[3][2] < 1


def brute_notices(text):
    """Labels and best share: every place of a key phrase, every word of its notice looked for around its own place."""
    w, labels, best = lower_words(text), set(), 0.0
    for label, notice, key in licenses.NOTICES:
        t, k = notice.split(), key.split()
        at = next(i for i in range(len(t)) if t[i:i + len(k)] == k)
        for s in range(len(w) - len(k) + 1):
            if w[s:s + len(k)] == k:
                near = [range(max(s - at + i - licenses.SLACK, 0), max(s - at + i + licenses.SLACK + 1, 0)) for i in range(len(t))]
                share = sum(t[i] in w[near[i].start:near[i].stop] for i in range(len(t))) / len(t)
                if share >= licenses.COVERAGE:
                    labels.add(label)
                    best = max(best, share)
    return labels, best


def test_notices_brute_force(spark):
    """Random cuts of every notice: the same findings whatever else is in the table."""
    rng = random.Random(5)
    texts = ["", "or modify it under the terms", " ".join(licenses.NOTICES[0][2].split())]
    for _, notice, _ in licenses.NOTICES:
        words = notice.split()
        for _ in range(12):
            a, b = rng.randint(0, 5), rng.randint(0, 5)
            cut = words[a:len(words) - b]
            for _ in range(rng.randint(0, 4)):
                cut.insert(rng.randint(0, len(cut)), rng.choice(["x", "the", "software", "license"]))
            texts.append(" ".join(["Some"] * rng.randint(0, 6) + cut) + rng.choice(["", ". " + notice.upper()]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    other = spark.createDataFrame([(1000 + i, n) for i, (_, n, _) in enumerate(licenses.NOTICES)] + [(2000, "associated documentation files")],
                                  "doc_id long, text string")
    got = {r["doc_id"]: r for r in licenses.scan(docs).collect()}
    for i, text in enumerate(texts):
        labels, best = brute_notices(text)
        base = {x for x in got[i]["base_labels"].split(",") if x}
        assert got[i]["labels"] == ",".join(sorted(labels | base)), text
        assert abs(got[i]["score"] - (1.0 if base else best)) < 1e-12, text
    again = {r["doc_id"]: r for r in licenses.scan(docs.unionByName(other)).where("doc_id < 1000").collect()}
    assert again == got and sum(bool(r["labels"]) for r in got.values()) > len(texts) // 2


# --- 4 mix ----------------------------------------------------------------

def test_mix_matches_sql(spark):
    got = mixing.mix_sizes(table(spark, SMALL, "documents"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    want = con.execute(mixing.OP4_SQL)
    names = [d[0] for d in want.description]
    assert digest(got.columns, [tuple(r) for r in got.collect()]) == digest(names, want.fetchall())


def test_mix_awkward(awkward, nothing):
    got = mixing.mix_sizes(awkward).collect()
    assert len(got) == len(AWKWARD)
    sizes = Counter()
    for _, t, _, s in AWKWARD:
        sizes[s] += len(plain_words(t))
    assert all(r["taken"] <= 3 * r["size"] and r["target"] <= 3 * r["source_size"] for r in got)
    assert sum({r["source_size"]: r["target"] for r in got}.values()) <= sum(sizes.values()) + 1e-6
    kept = mixing.mix(awkward)
    assert kept.columns == awkward.columns + ["copies"]
    assert rows(kept.select("doc_id", "copies")) == rows(mixing.mix(awkward).select("doc_id", "copies"))
    assert mixing.mix_sizes(nothing).count() == 0 and mixing.mix(nothing).count() == 0


def test_water_filling_reshares_the_excess(spark):
    sources = spark.createDataFrame([("a", 10, 1), ("b", 1000, 2), ("c", 20, 3)], "source string, source_size long, weight long")
    got = {r["source"]: r["target"] for r in mixing.water_fill(sources).collect()}
    assert got == {"a": 30.0, "b": 940.0, "c": 60.0}


# --- 5 rules --------------------------------------------------------------

def brute_rules(text):
    w = plain_words(text)
    cover = set()
    at = {}
    for k in range(len(w) - 7):
        at.setdefault(tuple(w[k:k + 8]), []).append(k)
    for ks in at.values():
        if len(ks) > 1:
            cover.update(p for k in ks for p in range(k, k + 8))
    lines, seen, repeats = (text or "").split("\n"), set(), 0
    for line in lines:
        if plain_words(line):
            repeats += line in seen
            seen.add(line)
    n = len(w)
    return (n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), repeats, len(cover), n < 20 or 100 * len(cover) > 30 * n)


def test_rules(spark, awkward, nothing):
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    want = sorted([(i, *brute_rules(t)) for i, t, _, _ in AWKWARD], key=lambda r: tuple((x is None, x) for x in r))
    assert rows(quality_rules.judge(awkward).select(*columns)) == want
    got = rows(quality_rules.judge(table(spark, SMALL, "documents")).select(*columns))
    assert got == sorted([(i, *brute_rules(t)) for i, t, _, _ in small_documents()])
    assert quality_rules.judge(nothing).count() == 0


def test_frequent_lines_go(spark):
    body = " ".join(f"w{k}" for k in range(30))
    docs = [(i, "Menu 1 of this site\n" + f"{i} " + " ".join(f"d{i}x{k}" for k in range(30)), "h") for i in range(30)]
    docs += [(100 + i, ("Menu  2 of THIS site\n" * 8) + f"own{i}", "h") for i in range(3)] + [(200, body, "h"), (201, body, "h")]
    got = {r["doc_id"]: r for r in quality_rules.judge(spark.createDataFrame(docs, "doc_id long, text string, source string"), most=20).collect()}
    assert all(got[i]["n_removed_words"] == 5 and got[i]["kept"] for i in range(30))
    assert all(got[100 + i]["n_removed_words"] == 40 and not got[100 + i]["kept"] for i in range(3))
    assert got[200]["kept"] and got[201]["kept"]


def test_one_limit_at_every_size_and_numbers_stay(spark):
    """A line's fate doesn't hang on its host's size, and tables of numbers are no boilerplate."""
    rnd = np.random.default_rng(1)
    docs = []
    for host, n in (("small", 30), ("large", 3000)):
        for i in range(n):
            body = " ".join(f"d{i}x{k}" for k in range(30))
            docs.append((len(docs), f"Share this 12 page\n{body}" if i < 25 else body, host))
    docs += [(10_000 + i, " ".join(str(x) for x in rnd.integers(1000, 9999, 25)), "numbers") for i in range(60)]
    got = quality_rules.judge(spark.createDataFrame(docs, "doc_id long, text string, source string")).collect()
    removed = {r["doc_id"]: r["n_removed_words"] for r in got}
    with_line = [i for i, t, _ in docs if t.startswith("Share")]
    assert len({h for _, t, h in docs if t.startswith("Share")}) == 2 and {removed[i] for i in with_line} == {4}
    assert all(removed[i] == 0 for i, _, h in docs if h == "numbers")
    assert all(r["kept"] for r in got)


def brute_kept(docs, most=20):
    """`kept` and removed words by plain loops."""
    def normal(line):
        w = line.lower().split()
        word = [re.search(r"[A-Za-z\u0080-\U0010ffff]", x) is not None for x in w]
        fold = 2 * sum(word) >= len(w)
        return " ".join(x if k or not fold else re.sub("[1-9]", "0", x) for x, k in zip(w, word, strict=True))

    split = lambda t: [line for line in re.split("\n", t or "") if plain_words(line)]
    lower = lambda t: (t or "").translate(AZ)
    texts: dict = {}
    for _, t, _, s in docs:
        for line in {normal(" ".join(plain_words(lower(x)))) for x in split(t)}:
            texts.setdefault((s, line), set()).add(t)
    out = []
    for i, t, _, s in docs:
        gone = sum(len(plain_words(x)) for x in split(t) if len(texts[s, normal(" ".join(plain_words(lower(x))))]) > most)
        n, rep = brute_rules(t)[0], brute_rules(t)[4]
        failed = n < 20 or 100 * rep > 30 * n
        depleted = gone > 0 and (n - gone < 20 or n - gone < 0.2 * n)
        out.append((i, gone, not failed and not depleted))
    return sorted(out)


def test_kept_brute_force(spark):
    docs = duckdb.sql("SELECT doc_id, text, lang, source FROM '/root/testdata/sf0.01/documents.parquet' WHERE length(text) < 3000 OR text IS NULL").fetchall()
    got = quality_rules.judge(spark.createDataFrame(docs, "doc_id long, text string, lang string, source string"))
    assert rows(got.select("doc_id", "n_removed_words", "kept")) == brute_kept(docs)


# --- 6 classifier ---------------------------------------------------------

def test_quality_scores(spark, awkward, nothing):
    docs, labels = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    got = quality_classifier.score_quality(docs, labels).where("held_out").join(labels, "doc_id").collect()
    good, bad = [r["score"] for r in got if r["quality"]], [r["score"] for r in got if not r["quality"]]
    assert np.mean([g > b for g in good for b in bad]) > 0.95
    scores = quality_classifier.score_quality(awkward, labels).collect()
    assert len(scores) == len(AWKWARD) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in scores)
    assert quality_classifier.score_quality(nothing, labels).count() == 0
    assert {r["score"] for r in quality_classifier.score_quality(awkward, labels.where("false")).collect()} == {0.5}


def test_quality_moments_match_numpy(spark):
    docs = table(spark, SMALL, "documents")
    x = quality_classifier.described(docs).withColumn("label", (F.col("doc_id") % 2).cast("int"))
    sums = quality_classifier.moments(x)
    own = np.array([np.frombuffer(r["x"]) for r in x.where("label = 1").collect()])
    assert sums[1][0] == len(own) and np.allclose(sums[1][2], own.T @ own)


# --- 7 decontamination ----------------------------------------------------

def brute_contamination(text, items):
    w = lower_words(text)
    hit, found = set(), set()
    for item, v in items:
        n = min(13, len(v))
        windows = {tuple(v[k:k + n]) for k in range(len(v) - n + 1)} if n else set()
        for k in range(len(w) - n + 1):
            if n and tuple(w[k:k + n]) in windows:
                hit.update(range(k, k + n))
                found.add(str(item))
    names = ",".join(sorted(found))
    return len(w), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(w)


COLUMNS7 = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def test_contamination(spark, awkward, nothing):
    from .conftest import PASSAGE
    items = [(1, PASSAGE.upper()), (2, "brown fox"), (3, None), (4, ""), (5, "?"), (6, "brown fox"), (7, "und das ist lang")]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("words", F.lit(1))
    words = [(i, lower_words(t)) for i, t in items]
    got = rows(decontam.contamination(awkward, bench).select(*COLUMNS7))
    assert got == sorted([(i, *brute_contamination(t, words)) for i, t, _, _ in AWKWARD], key=lambda r: tuple((x is None, x) for x in r))
    assert decontam.contamination(nothing, bench).count() == 0
    assert decontam.contamination(awkward, bench.where("false")).where("contaminated").count() == 0
    bad = sum(r[-1] for r in got)
    clean = decontam.decontaminate(awkward, bench)
    assert bad and clean.columns == awkward.columns and clean.count() == len(AWKWARD) - bad


def test_contamination_without_broadcast(spark, awkward, monkeypatch):
    bench = spark.createDataFrame([(1, "the lazy dog"), (2, "brown fox")], "item_id long, text string")
    want = rows(decontam.contamination(awkward, bench).select(*COLUMNS7))
    monkeypatch.setattr(decontam, "BROADCAST_ROWS", 0)
    assert rows(decontam.contamination(awkward, bench).select(*COLUMNS7)) == want


def test_proximity_matches(spark):
    docs = spark.createDataFrame([(1, "alpha beta x gamma delta y epsilon zeta"), (2, "alpha beta gamma delta epsilon zeta")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta")], "item_id long, text string")
    got = {(r["doc_id"], r["exact"], r["near"]) for r in decontam.matches(docs, bench).collect()}
    assert got == {(1, False, True), (2, True, False)}


def brute_places(w, windows):
    """(item, start, exact) of windows that stand whole, or whose rarest words stand near."""
    return {(item, s) for item, v in windows for s in range(len(w) - len(v) + 1) if w[s:s + len(v)] == v}


def test_index_against_brute_force(spark):
    rng = np.random.default_rng(7)
    vocabulary = [f"w{k}" for k in range(6)] + ["rare", "rarer"]
    say = lambda n: " ".join(rng.choice(vocabulary, n, p=[.3, .25, .2, .1, .06, .04, .03, .02]))
    items = [(k, say(int(n))) for k, n in enumerate([1, 2, 5, 13, 14, 40, 40])] + [(3, "w0 w0 w0"), (None, "w1 w0 w1")]
    texts = [say(int(n)) for n in rng.integers(0, 300, 40)]
    texts += [say(50) + " " + items[5][1] + " " + say(9), items[4][1] + " " + items[4][1], items[6][1][3:]] + ["w0 " * 900] * 3
    docs = [(k if k % 9 else None, t) for k, t in enumerate(texts)] + [(1, texts[1])] * 5
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = rows(decontam.contamination(spark.createDataFrame(docs, "doc_id long, text string"), bench).select(*COLUMNS7))
    words = [(i, lower_words(t)) for i, t in items]
    named = [(i, v) for i, v in words if i is not None]
    want = []
    for i, t in docs:
        n, hit, _, _, bad = brute_contamination(t, words)
        want.append((i, n, hit, *brute_contamination(t, named)[2:4], bad))
    assert got == sorted(want, key=lambda r: tuple((x is None, x) for x in r))
    # every place of every window, whatever else is in the table
    place = {(r["doc_id"], r["item_id"], r["start"], r["len"]) for r in decontam.matches(
        spark.createDataFrame(docs, "doc_id long, text string"), bench).where("exact").collect()}
    for i, t in docs:
        if i is not None:
            cut = [(k, v[s:s + 13]) for k, v in words for s in range(max(1, len(v) - 12))]
            assert {(k, s) for k, s in brute_places(lower_words(t), cut)} == {p[1:3] for p in place if p[0] == i}


def test_index_holds_postings_of_the_benchmark_only(spark):
    docs = spark.createDataFrame([(1, "a b c a"), (2, None), (3, "c c")], "doc_id long, text string")
    vocabulary = spark.createDataFrame([("a", 7), ("b", 8)], "word string, term long")
    index = decontam.positional_index(docs, vocabulary)
    assert {(r["doc"]["doc_id"], r["at"], r["term"]) for r in index.collect()} == {
        (1, 0, 7), (1, 1, 8), (1, 3, 7), (1, 4, -1), (2, 0, -1), (3, 2, -1)}


# --- 8 html ---------------------------------------------------------------

PAGE = ('<html><head><title>T</title><script>var t="</p>";</script></head><body class="has-sidebar"><nav><a href="/x">Home</a></nav>'
        '<div class="cookie-notice">We use cookies</div><article><header><h1>Head &amp; line</h1></header><p>One <b>two</b>,\n three<br>four'
        '<p>Five &eacute;&#233;<ul><li>a<li>b</ul><div class="share-buttons">Tweet</div><form><input>Send</form></article>'
        '<section id="comments"><article class="comment"><p>First!</p></article></section><footer>&copy; me</footer></body></html>')


def test_html_rules():
    assert html_extract.extract(PAGE, frozenset()) == "Head & line\nOne two, three four\nFive éé\na\nb"
    assert html_extract.extract("<p>a<p>b", frozenset()) == "a\nb"
    assert html_extract.extract("plain  text", frozenset()) == "plain text"


def test_html_templates(spark):
    pages = [(i, f"http://h.example/{i}", f"<body><div class='top'>Same words</div><div class='main'><p>Page {i} says {i * i}</p></div><div>Same end</div></body>")
             for i in range(40)]
    pages += [(100, None, None), (101, "nonsense", ""), (102, "http://h.example/x", "no tags"), (None, "http://h.example/0", PAGE), (0, *pages[0][1:])]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("host", F.lit("x")).withColumn("tokens", F.lit("x"))
    got = html_extract.main_text(df).collect()
    assert len(got) == len(pages)
    by_id = {r["page_id"]: (r["text"], r["n_chars"]) for r in got}
    assert by_id[3] == ("Page 3 says 9", 13)
    assert by_id[100] == ("", 0) and by_id[101] == ("", 0) and by_id[102] == ("no tags", 7)
    assert html_extract.main_text(df.where("false")).count() == 0


def test_html_of_the_given_pages(spark):
    import html as H
    got = {r["page_id"]: r["text"] for r in html_extract.main_text(table(spark, SMALL, "pages")).collect()}
    for i, page in duckdb.sql(f"SELECT page_id, html FROM '{SMALL}/pages.parquet'").fetchall():
        inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
        blocks = [re.sub(r"\s+", " ", H.unescape(re.sub(r"</?b>", "", re.sub("<br>", " ", x)))).strip() for x in re.split(r"</?(?:p|h1)>", inner)]
        assert got[i] == "\n".join(x for x in blocks if x)


def html_texts(spark, pages):
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    return {r["page_id"]: r["text"] for r in html_extract.main_text(df).collect()}


def test_html_template_decides_inside_articles(spark):
    """Lines of every page of a host go from its articles, and a slot outside that holds more text counts."""
    page = ("<html><body><article id='post-{0}'><h1>Title {0}</h1><p>Story {0} of <b>some</b> words.</p><p>Follow <i>us</i> by mail</p>"
            "<ul><li><a href='/a'>Top list</a></ul></article><div class='x'>Our partners and their many offers of this week</div></body></html>")
    other = "<html><body><div class='text'><p>The long report number {0} stands outside.</p></div><article>Card {0}</article></body></html>"
    got = html_texts(spark, [(i, "http://a.example/x", page.format(i)) for i in range(30)]
                     + [(100 + i, "http://b.example/x", other.format(i)) for i in range(30)])
    assert got[7] == "Title 7\nStory 7 of some words."
    assert got[7] != html_extract.extract(page.format(7), frozenset())
    assert got[107] == "The long report number 7 stands outside.\nCard 7"


def test_html_headings_of_every_article_stay(spark):
    """Headings between the slots of a template are the articles' own; a longer box beside a short article isn't its text."""
    page = ("<html><body><article><h2>Summary</h2><p>Words {0} first.</p><h2>Conclusion</h2><p>Words {0} last.</p>"
            "<p>All rights reserved</p></article></body></html>")
    box = "<html><body><article><p>Short {0}.</p></article><div class='box'>An unrelated box, number {0}, longer than the article</div></body></html>"
    got = html_texts(spark, [(i, "http://a.example/x", page.format(i)) for i in range(30)]
                     + [(100 + i, "http://b.example/x", box.format(i)) for i in range(30)]
                     + [(200 + i, "http://c.example/x", "<article><p>The same on every page</p></article>" + f"<div class='ad'>{i}</div>") for i in range(9)])
    assert got[7] == "Summary\nWords 7 first.\nConclusion\nWords 7 last."
    assert got[107] == "Short 7."
    assert got[207] == "The same on every page"


def test_html_copies_are_no_template(spark):
    """A third of a host's pages are copies, some with other adverts or titles; a host of four pages has its own template."""
    frame = "<html><body><div class='top'>All about {1}</div><div class='ad'>Offer {0}</div><div class='text'>{2}</div></body></html>"
    story = "".join(f"<p>Paragraph {k} of the story.</p>" for k in range(5))
    plain = story.replace("<p>", "").replace("</p>", "\n").strip()
    pages = [(i, "http://a.example/x", frame.format(0, "a", story)) for i in range(8)]
    pages += [(10 + i, "http://a.example/x", frame.format(i, "a", story)) for i in range(8)]
    pages += [(20 + i, "http://a.example/x", frame.format(i, "a", f"<p>Copy {i}</p>" + story)) for i in range(14)]
    pages += [(100 + i, "http://a.example/x", frame.format(i, "a", "".join(f"<p>Page {i}</p>" for _ in range(i % 4 + 1)))) for i in range(24)]
    pages += [(200 + i, "http://b.example/x", frame.format(i, "b", f"<p>Page {i}</p>")) for i in range(4)]
    pages += [(300 + i, "http://c.example/x", frame.format(i, "c", story)) for i in range(2)]
    got = html_texts(spark, pages)
    assert {got[i] for i in (*range(8), *range(10, 18))} == {plain}
    assert got[23] == "Copy 3\n" + plain and got[101] == "Page 1\nPage 1"
    assert got[202] == "Page 2" and got[300] == got[301] == "All about c\n" + plain


@pytest.mark.parametrize("page, text", [
    ("<body><div><p>The real text</p></div><aside><article>Teaser</article></aside><footer><article>Teaser</article></footer></body>", "The real text"),
    ("<article><header class='entry-header' id='top'><h1>Title</h1></header><p>Text</p><header class='ads'>Buy</header></article>", "Title\nText"),
    ("<main><div class='layout with-sidebar'><p>Text</p><div class='sidebar'>More</div><div class='share-buttons'>Tweet</div></div></main>", "Text"),
    ("<article class='post comments-open'><p>Text</p><div class='comment-list'>First!</div></article>", "Text"),
    ("<form id='aspnetForm'><main><p>Text</p><form>Send</form></main></form>", "Text"),
])
def test_html_tag_rules_keep_real_text(page, text):
    assert html_extract.extract(page, frozenset()) == text


# --- 9 substrings ---------------------------------------------------------

def brute_substrings(docs):
    """docs: (id, text) in any order; a null id takes no part."""
    first = {}
    for i, t in docs:
        b = (t or "").encode()
        for k in range(len(b) - 49) if i is not None else ():
            first[b[k:k + 50]] = min(i, first.get(b[k:k + 50], i))
    out = []
    for i, t in docs:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - 49) if i is not None else ():
            if first[b[k:k + 50]] < i:
                gone[k:k + 50] = b"\x01" * 50
        runs = sum(1 for k in range(len(b)) if gone[k] and not (k and gone[k - 1]))
        out.append((i, len(b), sum(gone), runs, hashlib.sha256(bytes(c for c, g in zip(b, gone, strict=True) if not g)).hexdigest()))
    return sorted(out, key=lambda r: tuple((x is None, x) for x in r))


def test_substrings(spark, awkward, nothing):
    assert rows(suffix_dedup.repeated_substrings(awkward)) == brute_substrings([(i, t) for i, t, _, _ in AWKWARD])
    assert rows(suffix_dedup.repeated_substrings(table(spark, SMALL, "documents"))) == brute_substrings([(i, t) for i, t, _, _ in small_documents()])
    assert suffix_dedup.repeated_substrings(nothing).count() == 0


def test_substrings_of_runs_and_overlaps(spark):
    texts = [(5, "a" * 200), (3, "a" * 60 + "b" * 70), (4, "ab" * 60), (9, "x" + "ab" * 40 + "y"), (1, "z" * 49), (2, "z" * 50), (7, "z" * 51),
             (8, "é" * 30), (6, "é" * 26 + "a")]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    assert rows(suffix_dedup.repeated_substrings(df)) == brute_substrings(texts)


def test_two_stage_sort_is_a_suffix_sort():
    rng = np.random.default_rng(3)
    for letters in (1, 2, 4, 200):
        x = np.concatenate([rng.integers(1, 1 + letters, 400).astype(np.uint8), np.full(51, 255, np.uint8)])
        got = suffix_dedup.sorted_windows(x, np.arange(351))
        keys = [x[i:i + 50].tobytes() for i in got]
        assert keys == sorted(keys) and sorted(got) == list(range(351))


def test_without_repeats(awkward):
    out = suffix_dedup.without_repeats(awkward)
    assert out.columns == awkward.columns
    kept = {(r["doc_id"], r["text"]) for r in out.collect()}
    assert (1, AWKWARD[0][1]) in kept and not any(i == 2 for i, _ in kept)
    assert (3, None) in kept and (4, "") in kept


# --- 10 similar documents -------------------------------------------------

def brute_components(docs):
    sets = []
    for _, t in docs:
        w = plain_words((t or "").translate(AZ))
        sets.append(frozenset(zip(*(w[k:] for k in range(5)), strict=False)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    comp = list(range(len(docs)))
    for a in range(len(docs)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]) and comp[a] != comp[b]:
                comp = [comp[a] if c == comp[b] else c for c in comp]
    ids = {}
    for k, (i, _) in enumerate(docs):
        if i is not None:
            ids[comp[k]] = min(i, ids.get(comp[k], i))
    out = [(i, len(sets[k]), (ids.get(comp[k]) if sets[k] else i)) for k, (i, _) in enumerate(docs)]
    return sorted(out, key=lambda r: tuple((x is None, x) for x in r))


COLUMNS10 = ["doc_id", "n_shingles", "component_id"]


def near_copies():
    rng = np.random.default_rng(5)
    base = [f"w{k}" for k in rng.integers(0, 500, 120)]
    out = [(i, " ".join(base[:k] + ["edit%d" % i] + base[k + 1:])) for i, k in enumerate(rng.integers(0, 120, 80))]
    out += [(100 + i, " ".join(base[:60] + [f"v{k}" for k in rng.integers(0, 500, 60)])) for i in range(40)]
    return out + [(200 + i, " ".join(base[:n])) for i, n in enumerate(range(80, 120, 4))]


@pytest.mark.parametrize("chunk", [jaccard_join.CHUNK, 30])
def test_near_copies(spark, monkeypatch, chunk):
    monkeypatch.setattr(jaccard_join, "CHUNK", chunk)
    docs = near_copies()
    got = rows(jaccard_join.similar_documents(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)).select(*COLUMNS10))
    assert got == brute_components(docs)


def families():
    """Families of documents that share half of their words, and now and then a phrase with one of the next family."""
    rng = np.random.default_rng(9)
    def word(*at):
        return "x".join(map(str, at))
    docs = []
    for f in range(8):
        passage = [word("p", f, k) for k in range(60)]
        for j in range(12):
            own = [word("o", f, j, k) for k in range(44)]
            own[10:18] = [word("g", f, j, k) for k in range(8)]
            own[24:32] = [word("g", (f + 1) % 8, j, k) for k in range(8)]
            docs.append((100 * f + j, " ".join(passage + own)))
    for i, t in docs[::7]:  # and copies, of which some link
        w = t.split()
        for k in rng.integers(0, len(w), int(rng.integers(1, 6))):
            w[k] = f"edit{i}"
        docs.append((5000 + i, " ".join(w)))
    return docs


@pytest.mark.parametrize("small", [jaccard_join.SMALL, 2])
def test_unrelated_families_stay_out_of_one_block(spark, monkeypatch, small):
    """Phrases that families share by chance don't make every set travel once a chunk of all families."""
    sent, search = [], jaccard_join.block_links
    monkeypatch.setattr(jaccard_join, "CHUNK", 20)
    monkeypatch.setattr(jaccard_join, "SMALL", small)
    monkeypatch.setattr(jaccard_join, "block_links", lambda rows: (sent.append(rows.count()), search(rows))[1])
    docs = families()
    got = rows(jaccard_join.similar_documents(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), links=False).select(*COLUMNS10))
    assert got == brute_components(docs)
    assert sent[0] <= 2 * len(docs)


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return set(re.findall(r"shuffle_\d+_\d+_\d+\.data", files.mkString(" ")))


@pytest.mark.parametrize("keep", [saved, written])
def test_shuffle_files_go_when_a_step_is_stored(spark, keep):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, setting = shuffle_files(spark), spark.conf.get(name)
    out = keep(spark.range(5000).repartition(3, "id").groupBy((F.col("id") % 7).alias("k")).count())
    for _ in range(40):  # they go in the background
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.25)
    assert not left and spark.conf.get(name) == setting
    assert sorted(r["k"] for r in out.collect()) == list(range(7))


def test_similar_awkward(spark, awkward, nothing):
    assert rows(jaccard_join.similar_documents(awkward).select(*COLUMNS10)) == brute_components([(i, t) for i, t, _, _ in AWKWARD])
    docs = [(i, t) for i, t, _, _ in small_documents()]
    assert rows(jaccard_join.similar_documents(table(spark, SMALL, "documents")).select(*COLUMNS10)) == brute_components(docs)
    assert jaccard_join.similar_documents(nothing).count() == 0


def brute_links(docs):
    sets = []
    for _, t in docs:
        w = plain_words((t or "").translate(AZ))
        sets.append(frozenset(zip(*(w[k:] for k in range(5)), strict=False)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    out = [(i, sum(b != a and 100 * len(x & y) >= 80 * len(x | y) for b, y in enumerate(sets)) if x else 0)
           for a, ((i, _), x) in enumerate(zip(docs, sets, strict=True))]
    return sorted(out, key=lambda r: tuple((v is None, v) for v in r))


@pytest.mark.parametrize("chunk, shingles", [(jaccard_join.COUNT_CHUNK, jaccard_join.COUNT_SHINGLES), (20, 1 << 19), (1000, 900)])
def test_numbers_of_links(spark, monkeypatch, chunk, shingles):
    monkeypatch.setattr(jaccard_join, "COUNT_CHUNK", chunk)
    monkeypatch.setattr(jaccard_join, "COUNT_SHINGLES", shingles)
    docs = near_copies()
    docs += [(300 + i, t) for i, (_, t) in enumerate(docs[:9])] + [(i, t) for i, t, _, _ in AWKWARD]
    found = jaccard_join.similar_documents(spark.createDataFrame(docs, "doc_id long, text string").repartition(4))
    assert rows(found.select("doc_id", "n_links")) == brute_links(docs)


def test_one_of_each(awkward):
    out = jaccard_join.one_of_each(awkward)
    assert out.columns == awkward.columns
    got = Counter(r["doc_id"] for r in out.collect())
    assert got[1] == 1 and got[2] == 0 and got[13] == 1 and got[14] == 0 and got[9] == 2 and got[3] == got[4] == got[5] == 1


def test_prefix_guarantee():
    """Sets that link share least_shared() prefix shingles in any order."""
    rng = np.random.default_rng(11)
    for _ in range(300):
        n = int(rng.integers(1, 60))
        a = set(rng.choice(10_000, n, replace=False).tolist())
        b = set(list(a)[int(rng.integers(0, n // 5 + 1)):]) | set(rng.integers(20_000, 30_000, int(rng.integers(0, n // 5 + 1))).tolist())
        if not b or 100 * len(a & b) < 80 * len(a | b):
            continue
        pre = [set(sorted(s)[:int(jaccard_join.prefix_length(np.array([len(s)]))[0])]) for s in (a, b)]
        for s in (a, b):
            assert len(pre[0] & pre[1]) >= 1 + (80 * len(s) // 100) // jaccard_join.EXTRA


def test_components_of_a_long_path(spark):
    rng = np.random.default_rng(2)
    path = rng.permutation(300).tolist()
    edges = list(zip(path[:200], path[1:201], strict=True)) + [(path[299], path[298])]
    got = {r["node"]: r["comp"] for r in jaccard_join.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[n] for n in path[:201]} == {min(path[:201])} and got[path[299]] == got[path[298]] == min(path[298:])


# --- pipeline -------------------------------------------------------------

def test_pipeline_against_brute_force(spark):
    docs = table(spark, SMALL, "documents")
    model = langid.fit(docs)
    known = {r["doc_id"]: r["text"] for r in langid.identify(docs, model).where(
        F.col("lang_pred") != "und").collect()}
    comps = {r[0]: r[2] for r in brute_components(sorted(known.items()))}
    one = {i: t for i, t in known.items() if comps[i] == i}
    cut = {}
    for i, n, removed, _, sha in brute_substrings(sorted(one.items())):
        if removed < n or not removed:
            cut[i] = (n - removed, sha)
    items = [(i, lower_words(t)) for i, t in duckdb.sql(f"SELECT item_id, text FROM '{SMALL}/benchmark.parquet'").fetchall()]
    staged = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        staged = corpus_pipeline.written(stage(spark, staged, SMALL))
        assert staged.columns == docs.columns, name
    clean = {r["doc_id"]: r["text"] for r in staged.collect()}
    passages = {r["doc_id"]: r["text"] for r in suffix_dedup.without_repeats(spark.createDataFrame(sorted(one.items()), "doc_id long, text string")).collect()}
    assert set(passages) == set(cut)
    assert clean == {i: t for i, t in passages.items() if not brute_contamination(t, items)[-1]}
    last = corpus_pipeline.run(spark, SMALL)
    assert last.columns == docs.columns + ["copies"]
    want = {r["doc_id"]: r["copies"] for r in mixing.mix_sizes(staged).collect() if r["copies"]}
    assert {r["doc_id"]: r["copies"] for r in last.collect()} == want


def test_pipeline_stages_take_awkward_rows(spark, awkward, nothing):
    docs = awkward.select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing.select(docs.columns), SMALL).count() == 0, name
        out = stage(spark, docs, SMALL)
        assert out.columns[:5] == docs.columns and out.count() >= 1, name


def test_sql_of_decontamination(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    want = con.execute(decontam.OP7_SQL)
    names = [d[0] for d in want.description]
    got = decontam.contamination(table(spark, SMALL, "documents"), table(spark, SMALL, "benchmark")).select(*COLUMNS7)
    assert digest(got.columns, [tuple(r) for r in got.collect()]) == digest(names, want.fetchall())
