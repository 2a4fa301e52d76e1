"""Token alignment, SimHash and runs against brute force, on awkward rows and off the repository path."""
from __future__ import annotations

import hashlib
import os
import random
import re
import subprocess
import sys
import textwrap
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer
from pyspark.sql import functions as F

from auric.llm import alignment, periodic_runs, simhash
from auric.llm.textbatch import table

from .conftest import AWKWARD, rows

SMALL = "/root/testdata/sf0.001"
PATH_A, PATH_B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TOKENIZER = Tokenizer.from_file(PATH_A)
TOKENIZER.encode_special_tokens = True
AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LETTERS = ["a", "b", " ", "  ", "\n", "\t", "é", "中", "国", "。", "，", "the ", "ing", "1", "23", "'s", "!!", "<s>", "<|endoftext|>",
           "<0x41>", "ß", "́", "🙂", " the", "\r\n", " ", "\x1c", "\x00", "あ", "x"]


def plain_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# --- 11 alignment ---------------------------------------------------------

def brute_alignment(docs):
    """The contract's rows by two loops over the tokens of each text."""
    a, b = alignment.TokenizerA(PATH_A), alignment.TokenizerB(PATH_B)
    out, links, holding = [], [], Counter()
    for i, text in docs:
        spaced = " " + (text or "")
        ids_a = TOKENIZER.encode(spaced, add_special_tokens=False).ids if text else []
        ids_b = b.model.encode(text) if text else []
        if b"".join(a.bytes[x] for x in ids_a) != spaced.encode() or b"".join(b.bytes[x] for x in ids_b) != spaced.encode():
            ids_a = ids_b = []
        ends_a = np.cumsum([0] + [len(a.bytes[x]) for x in ids_a]).tolist()
        ends_b = np.cumsum([0] + [len(b.bytes[x]) for x in ids_b]).tolist()
        own, j0 = [], 0
        for k, x in enumerate(ids_a):
            while j0 < len(ids_b) and ends_b[j0 + 1] <= ends_a[k]:
                j0 += 1
            j = j0
            while j < len(ids_b) and ends_b[j] < ends_a[k + 1]:
                own.append((x, ids_b[j]))
                j += 1
        groups, x, y = [], 0, 0
        place_a, place_b = ({e: k for k, e in enumerate(ends)} for ends in (ends_a, ends_b))
        for end in sorted((set(ends_a) & set(ends_b)) - {0}):
            nx, ny = place_a[end], place_b[end]
            groups.append(",".join(map(str, ids_a[x:nx])) + "|" + ",".join(map(str, ids_b[y:ny])))
            x, y = nx, ny
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if ids_a else ""
        holding.update(set(own))
        links.append(own)
        out.append((i, len(ids_a), len(ids_b), len(groups), len(own), digest))
    best = defaultdict(int)
    for (x, _), n in holding.items():
        best[x] = max(best[x], n)
    return [(*o[:5], sum(holding[p] == best[p[0]] for p in own), sum(holding[p] for p in own), o[5])
            for o, own in zip(out, links, strict=True)]


def by_key(found):
    return sorted(found, key=lambda r: tuple((x is None, x) for x in r))


@pytest.mark.parametrize(("chunk", "fan", "hot"), [(5, 2, 50), (23, 4, 1 << 20), (1 << 16, 64, 0)])
def test_alignment_brute_force(spark, chunk, fan, hot):
    rnd = random.Random(chunk)
    docs = [(k, "".join(rnd.choice(LETTERS) for _ in range(rnd.randint(0, 90)))) for k in range(60)]
    docs += [(70, None), (71, ""), (72, " "), (73, "   "), (74, "中" * 200), (75, "x" * 200), (76, "with ▁ inside"), (77, "▁"),
             (74, "中" * 200)]
    got = alignment.align(spark.createDataFrame(docs, "doc_id long, text string"), PATH_A, PATH_B, chunk, fan).digest(hot)
    assert by_key(map(tuple, got.collect())) == by_key(brute_alignment(docs))


def test_alignment_awkward(spark, awkward, nothing):
    docs = [(r[0], r[1]) for r in AWKWARD]
    got = alignment.align(awkward, PATH_A, PATH_B, chunk=5000, fan=8).digest()
    assert by_key(map(tuple, got.collect())) == by_key(brute_alignment(docs))
    assert alignment.align(nothing, PATH_A, PATH_B).digest().count() == 0


def test_alignment_groups_are_the_text(spark):
    docs = [(1, "Plain words, then 中国人民。 and more of them\n\nhere"), (2, None)]
    got = alignment.align(spark.createDataFrame(docs, "doc_id long, text string"), PATH_A, PATH_B, chunk=7, fan=2).groups()
    parts = sorted((r["at"], r["groups"]) for r in got.collect() if r["groups"])
    a, b = alignment.TokenizerA(PATH_A), alignment.TokenizerB(PATH_B)
    for side, model in ((0, a), (1, b)):
        ids = [int(x) for _, groups in parts for g in groups.split(";") for x in g.split("|")[side].split(",")]
        assert b"".join(model.bytes[x] for x in ids) == (" " + docs[0][1]).encode()


def test_fragments_compose_in_any_order():
    """Composing is associative: every way to bracket a text's ranges gives the same parts."""
    rnd = random.Random(3)
    width_a, width_b = np.arange(6), np.arange(6)
    for _ in range(200):
        total = rnd.randint(1, 40)

        def side(total=total):
            out = []
            while (left := total - sum(out)) > 0:
                out.append(min(left, rnd.randint(1, 5)))
            return out

        a, b = side(), side()
        pieces = rnd.randint(1, 4)
        cuts_a, cuts_b = (sorted(rnd.choices(range(len(x) + 1), k=pieces - 1)) for x in (a, b))
        opens = [alignment.Open(np.array(a[i:j], np.int64), np.array(b[k:m], np.int64), sum(a[:i]), sum(b[:k]))
                 for i, j, k, m in zip([0, *cuts_a], [*cuts_a, len(a)], [0, *cuts_b], [*cuts_b, len(b)], strict=True)]

        def fold(order, opens=opens):
            parts, items = [], []
            for o in opens:
                f, part = alignment.scan(o, width_a, width_b)
                items.append(f)
                parts.append(part)
            while len(items) > 1:
                k = order(len(items) - 1)
                f, part = alignment.compose(items[k], items[k + 1], width_a, width_b)
                items[k:k + 2] = [f]
                parts.append(part)
            done = sorted(((p.a_at, p.a.tolist(), p.b.tolist()) for p in parts if p), key=lambda p: p[0])
            f = items[0]
            assert f.cut and not len(f.prefix.a) and not len(f.prefix.b) and not len(f.suffix.a) and not len(f.suffix.b)
            return [x for _, xs, _ in done for x in xs], [y for _, _, ys in done for y in ys]

        assert fold(lambda n: 0) == fold(lambda n: n - 1) == fold(lambda n: rnd.randrange(n)) == (a, b)


# --- 12 SimHash -----------------------------------------------------------

def brute_fingerprint(text):
    w = plain_words((text or "").translate(AZ))
    shingles = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def brute_components(ids, fps):
    fps, parent = np.array(fps, np.uint64), list(range(len(ids)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = []
    for i in range(len(ids)):
        near = np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= 2)
        links.append(len(near) - 1)
        for j in near:
            a, b = find(i), find(int(j))
            parent[max(a, b)] = min(a, b)
    least = {}
    for i, name in enumerate(ids):
        known = least.get(find(i))
        least[find(i)] = known if name is None else name if known is None else min(known, name)
    return [(name, format(int(f), "016x"), least[find(i)], n) for i, (name, f, n) in enumerate(zip(ids, fps, links, strict=True))]


@pytest.mark.parametrize("tile", [2, 2048])
def test_simhash_brute_force(spark, tile):
    docs = table(spark, SMALL, "documents").select("doc_id", "text")
    texts = [tuple(r) for r in docs.collect()]
    got = simhash.similar_fingerprints(docs, tile).select("doc_id", "fingerprint", "component_id", "n_links")
    assert rows(got) == by_key(brute_components([i for i, _ in texts], [brute_fingerprint(t) for _, t in texts]))


@pytest.mark.parametrize("tile", [3, 7, 64])
def test_simhash_tiles_of_a_hot_group(spark, tile):
    """Very many fingerprints around one centre: every link is found whatever the tiles."""
    rnd = random.Random(tile)
    fps = [0, (1 << 64) - 1]
    for _ in range(150):
        f = 0x5A5A5A5A5A5A5A5A
        for k in rnd.sample(range(64), rnd.randint(0, 5)):
            f ^= 1 << k
        fps.append(f)
    distinct = sorted(set(fps))
    nodes = spark.createDataFrame([(simhash._signed(f), rnd.randint(1, 3)) for f in distinct], "fp long, copies long")
    copies = {r["fp"] & ((1 << 64) - 1): r["copies"] for r in nodes.collect()}
    links = simhash.compare_tiles(simhash.tile_pairs(nodes, tile), 4).collect()
    degree = Counter()
    for r in links:
        degree[r["a"] & ((1 << 64) - 1)] += r["n"]
    expected = {f: sum(copies[g] for g in distinct if g != f and (f ^ g).bit_count() <= 2) for f in distinct}
    assert dict(degree) == {f: n for f, n in expected.items() if n}


def test_simhash_awkward(spark, awkward, nothing):
    ids, texts = [r[0] for r in AWKWARD], [r[1] for r in AWKWARD]
    got = simhash.similar_fingerprints(awkward).select("doc_id", "fingerprint", "component_id", "n_links")
    assert rows(got) == by_key(brute_components(ids, [brute_fingerprint(t) for t in texts]))
    assert simhash.similar_fingerprints(nothing).count() == 0


# --- 13 runs --------------------------------------------------------------

def brute_runs(words, least=12):
    n, out = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            seg = words[i:i + length]
            if length >= max(least, 2 * q) and not any(seg[d:] == seg[:-d] for d in range(1, q)):
                out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_lyndon(text):
    out = []
    for i in range(len(text)):
        best = 1
        for j in range(i + 1, len(text) + 1):
            w = text[i:j]
            if 0 in w:
                break
            if all(w < w[k:] for k in range(1, len(w))):
                best = len(w)
        out.append(best)
    return out


def test_lyndon_array_by_grouping():
    rnd = random.Random(1)
    for _ in range(400):
        text = [0] + [rnd.randint(0, rnd.randint(1, 4)) for _ in range(rnd.randint(1, 24))]
        got = periodic_runs.lyndon(np.array(text)).tolist()
        assert [g for g, c in zip(got, text, strict=True) if c] == [x for x, c in zip(brute_lyndon(text), text, strict=True) if c]


@pytest.mark.parametrize("least", [2, 5, 12])
def test_runs_brute_force(least):
    rnd = random.Random(least)
    for _ in range(150):
        docs = []
        for _ in range(rnd.randint(1, 4)):
            words: list[int] = []
            while len(words) < rnd.randint(0, 60):
                if rnd.random() < 0.6:
                    unit = [rnd.randint(1, 3) for _ in range(rnd.randint(1, 7))]
                    words += (unit * rnd.randint(2, 6))[:rnd.randint(1, 40)]
                else:
                    words.append(rnd.randint(1, 9))
            docs.append(words)
        flat = np.array([w for d in docs for w in d], np.int64)
        owner = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
        expected, base = [], 0
        for d in docs:
            expected += [(s + base, n, q) for s, n, q in brute_runs(d, least)]
            base += len(d)
        assert list(map(tuple, periodic_runs.find_runs(flat, owner, least).tolist())) == expected


def expected_runs(doc_id, text):
    words, h = plain_words(text), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and words:
        n, g = len(words), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute_runs(words)
    best = max(found, key=lambda r: (r[1], -r[0], -r[2])) if found else None
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(words), len(found), *(best or (None, None, None)), 1000 * best[1] // best[2] if best else None,
            sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def runs_of(docs):
    return rows(periodic_runs.digests(periodic_runs.collapse_runs(periodic_runs.with_planted(docs))))


def test_runs_of_the_given_documents(spark):
    docs = table(spark, SMALL, "documents").where("length(text) < 4000 or text is null").select("doc_id", "text")
    expected = by_key(expected_runs(*r) for r in docs.collect())
    assert runs_of(docs) == expected
    assert sum(r[2] > 0 for r in expected) > len(expected) / 20


def test_runs_awkward(spark, awkward, nothing):
    short = awkward.where("doc_id is null or doc_id <> 6")
    assert runs_of(short) == by_key(expected_runs(r[0], r[1]) for r in AWKWARD if r[0] != 6)
    repeated = " ".join(["again and again"] * 10 + ["then", "on"] * 20 + ["x"] * 13)
    got = periodic_runs.collapse_runs(spark.createDataFrame([(1, repeated)], "doc_id long, text string")).first()
    assert got["collapsed"] == "again and again then on x"
    assert periodic_runs.collapse_runs(nothing).count() == 0


def test_runs_of_a_very_long_text(spark):
    """Work grows with the length, not with its square, whatever repeats."""
    text = " ".join(["a"] * 150_000 + [f"w{i % 5000}" for i in range(150_000)])
    got = periodic_runs.collapse_runs(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert [tuple(r) for r in got["runs"]] == [(0, 150_000, 1), (150_000, 150_000, 5000)]


# --- executors without the repository -------------------------------------

def test_queries_need_no_repository_on_the_workers(tmp_path):
    """Every query of the subpackage runs with workers that can't import the library."""
    script = tmp_path / "off_path.py"
    repo = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    script.write_text(textwrap.dedent(f"""
        import sys
        sys.path.insert(0, {repo!r})
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false")
                 .config("spark.ui.showConsoleProgress", "false").config("spark.sql.shuffle.partitions", "4")
                 .config("spark.checkpoint.dir", {str(tmp_path / "shared")!r}).getOrCreate())
        from auric.llm.queries import QUERIES

        def absent(batches):
            import importlib.util
            import pyarrow as pa
            for _ in batches:
                pass
            yield pa.RecordBatch.from_arrays([pa.array([importlib.util.find_spec("auric") is None])], names=["absent"])

        assert spark.range(1).mapInArrow(absent, "absent boolean").first()[0]
        for name, query in QUERIES.items():
            assert query(spark, {SMALL!r}).count() > 0, name
        print("all", len(QUERIES))
    """))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert done.returncode == 0 and "all 13" in done.stdout, done.stdout[-500:] + done.stderr[-3000:]
