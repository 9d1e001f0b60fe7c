"""Links, components, passages, archives and mixtures against plain Python."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sparkseries.llm import passages
from sparkseries.llm.components import components
from sparkseries.llm.mixing import mixed
from sparkseries.llm.neardup import half_keys_for, near_duplicates
from sparkseries.llm.passages import chains, columns, cut_words, repeated_passages, stretches, without_passages
from sparkseries.llm.warc import MAGIC, RECORD_END, read_archives, round_trip, write_archives

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def docs_of(spark, rows, extra="kept"):
    return spark.createDataFrame([(i, t, "old") for i, t in rows], f"doc_id long, text string, {extra} string")


def roots_of(nodes, edges):
    low = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            m = min(low[a], low[b])
            changed |= low[a] != m or low[b] != m
            low[a] = low[b] = m
    return low


@pytest.mark.parametrize("kind", ["path", "star", "random", "empty"])
def test_components(spark, kind):
    rng = random.Random(3)
    names = list(range(1, 60))
    rng.shuffle(names)
    edges = {"path": list(zip(names, names[1:])), "star": [(7, n) for n in names], "empty": [],
             "random": [(rng.randrange(60), rng.randrange(60)) for _ in range(40)]}[kind]
    out = {r.id: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    real = [(a, b) for a, b in edges if a != b]
    assert out == roots_of({n for e in real for n in e}, real)


def shingles(text, size):
    w = WORDS.findall((text or "").translate(LOWER))
    return {tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def near_rows(rng):
    pool = [f"v{i}" for i in range(400)]
    base = [[rng.choice(pool) for _ in range(rng.randrange(30, 120))] for _ in range(8)]
    rows = [(i, t) for i, t in enumerate([None, "", " \n", "a", "A", "a b", "a  B", "a b c", "b"])]
    for b in base:
        for _ in range(9):
            w = list(b)
            for _ in range(rng.randrange(0, 6)):
                w[rng.randrange(len(w))] = rng.choice(pool)
            rows.append((len(rows), " ".join(w)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("size, least", [(3, (85, 100)), (5, (8, 10))])
def test_near_duplicates(spark, size, least):
    rows = near_rows(random.Random(size))
    rows += [(None, rows[0][1]), (rows[5][0], rows[5][1])]
    sets = {i: shingles(t, size) for i, t in rows if i is not None}
    edges = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and least[1] * len(sets[a] & sets[b]) >= least[0] * len(sets[a] | sets[b])]
    low = roots_of(sets, edges)
    out = near_duplicates(docs_of(spark, rows), shingle=size, least=least).collect()
    assert len(out) == len(rows)
    for r in out:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), low[r.doc_id], low[r.doc_id] == r.doc_id)
    assert near_duplicates(docs_of(spark, [])).count() == 0


def test_tables_meet_the_miss_bound():
    for s in (0.8, 0.85):
        m = half_keys_for(s, 3, 5e-4)
        assert 1 - (1 - (1 - s**3) ** m) ** 2 <= 5e-4


# ------------------------------------------------------------------ passages


def passage_rows():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    text = lambda n: [word() for _ in range(n)]
    exact, fuzzy, short = text(60), text(120), text(30)
    worn = list(fuzzy)
    for i in (20, 55, 90):
        worn[i] = word()
    del worn[70]
    rows = [(1, text(80) + exact + text(40)), (2, text(10) + exact), (3, exact + text(100)), (4, text(50) + fuzzy + text(20)),
            (5, text(5) + worn + text(60)), (6, text(40) + short + text(40)), (7, short + text(90)), (8, text(400)), (9, ["same"] * 90), (10, ["same"] * 90)]
    return [(i, " ".join(w)) for i, w in rows] + [(11, None), (12, ""), (13, "a b"), (None, " ".join(exact))]


def test_passages(spark):
    docs = docs_of(spark, passage_rows(), "source_doc_id")
    out = {(r.doc_id, r.source_doc_id): r for r in repeated_passages(docs).collect()}
    assert {k for k in out if k[0] not in (9, 10)} == {(2, 1), (3, 1), (5, 4)}
    assert (out[2, 1].start_word, out[2, 1].end_word, out[2, 1].source_start, out[2, 1].n_agree) == (10, 70, 80, 60)
    assert (out[3, 1].start_word, out[3, 1].end_word) == (0, 60)
    worn = out[5, 4]
    assert (worn.start_word, worn.end_word, worn.source_start, worn.source_end) == (5, 124, 50, 170) and worn.n_agree >= 115
    left = {r.doc_id: r.text for r in without_passages(docs, repeated_passages(docs)).collect()}
    before = dict(passage_rows())
    assert len(left[3].split()) == 100 and left[1] == before[1] and left[11] is None and left[12] == "" and left[None] == before[None]
    assert repeated_passages(docs_of(spark, [])).count() == 0


def test_passages_of_copies_and_emptied_texts(spark):
    rng = random.Random(2)
    text = " ".join(str(rng.random()) for _ in range(70))
    docs = docs_of(spark, [(i, text) for i in range(6)], "x")
    found = repeated_passages(docs)
    assert {(r.doc_id, r.source_doc_id, r.start_word, r.end_word) for r in found.collect()} == {(i, 0, 0, 70) for i in range(1, 6)}
    assert [r.doc_id for r in without_passages(docs, found).collect()] == [0]


def test_chains_have_the_best_score():
    """The Fenwick tree finds the same best chain score as the quadratic recurrence."""
    rng = np.random.default_rng(1)
    for _ in range(50):
        n = int(rng.integers(2, 25))
        x, y = rng.integers(0, 60, n), rng.integers(0, 60, n)
        best = {}
        for i in sorted(range(n), key=lambda i: (x[i], -y[i])):
            best[i] = 5 + max([0.0] + [best[j] - 0.25 * (x[i] - x[j] + y[i] - y[j]) for j in best if x[j] < x[i] and y[j] < y[i]])
        found = chains(x, y, 5)
        total = lambda p: 5 * len(p) - 0.25 * (x[p[-1]] - x[p[0]] + y[p[-1]] - y[p[0]])
        if found and max(best.values()) > 5:
            assert max(total(p) for p in found) == pytest.approx(max(best.values()))
        assert all((np.diff(x[p]) > 0).all() and (np.diff(y[p]) > 0).all() for p in found)


def test_straight_chains_hold_those_of_the_tree():
    rng = np.random.default_rng(2)
    for _ in range(50):
        x = np.unique(rng.integers(0, 400, int(rng.integers(2, 40))))
        whole = [set(p.tolist()) for p in passages.straight(x)]
        for path in chains(x, x - 7, passages.WEIGHT):
            assert any(set(path.tolist()) <= w for w in whole)


def test_two_passages_with_a_gap_are_both_found(spark):
    """Passages of one pair, at any gap between them, in both texts or in one."""
    rng = random.Random(11)
    text = lambda n: [str(rng.random()) for _ in range(n)]
    rows, want = [], {}
    for length in (60, 100):
        for gap, other in ((10, 10), (40, 40), (60, 60), (75, 75), (110, 110), (40, 0), (0, 55), (30, 70)):
            one, two, i = text(length), text(length), len(rows)
            rows += [(i, text(20) + one + text(gap) + two + text(30)), (i + 1, text(7) + one + text(other) + two + text(9))]
            want[i + 1] = set(range(7, 7 + length)) | set(range(7 + length + other, 7 + 2 * length + other))
    found = {}
    for r in repeated_passages(docs_of(spark, [(i, " ".join(w)) for i, w in rows])).collect():
        assert r.source_doc_id == r.doc_id - 1 and r.end_word - r.start_word >= 50
        assert r.n_agree >= 0.8 * max(r.end_word - r.start_word, r.source_end - r.source_start)
        found.setdefault(r.doc_id, set()).update(range(r.start_word, r.end_word))
    assert all(want[i] <= found.get(i, set()) for i in want)


def exact_repeats(rows, size=50):
    """Words of each text that are in `size` words which stand in a text of a smaller id."""
    first, out = {}, {}
    for i, w in sorted(rows):
        for j in range(len(w) - size + 1):
            if first.setdefault(tuple(w[j:j + size]), i) != i:
                out.setdefault(i, set()).update(range(j, j + size))
    return out


def test_passages_whose_parts_stand_elsewhere(spark):
    """A passage of lines that each stand in an earlier document, also overlapping ones."""
    rng = random.Random(12)
    text = lambda n: [str(rng.random()) for _ in range(n)]
    rows = []
    for step in (20, 10, 5):
        for _ in range(4):
            shared = text(100)
            rows += [(len(rows) + j, text(40) + shared[at:at + 20] + text(40)) for j, at in enumerate(range(0, 100, step))]
            rows += [(len(rows) + j, text(rng.randrange(60)) + shared + text(30)) for j in range(2)]
    want = exact_repeats(rows)
    assert len(want) == 12
    found = {}
    for r in repeated_passages(docs_of(spark, [(i, " ".join(w)) for i, w in rows])).collect():
        found.setdefault(r.doc_id, set()).update(range(r.start_word, r.end_word))
    assert found == want


def test_passages_that_repeat_inside_a_text(spark):
    """All copies of a passage are cut but the first, alike ones too, and phrases before it do no harm."""
    rng = random.Random(13)
    text = lambda n: [str(rng.random()) for _ in range(n)]
    shared, own, worn = text(80), text(60), text(120)
    other = list(worn)
    for i in (17, 40, 61, 90, 104):
        other[i] = str(rng.random())
    phrases = [w for at in (60, 40, 20, 0) for w in shared[at:at + 20] + text(3)]
    rows = [(1, text(9) + phrases + shared + text(40)), (2, shared + text(30) + shared + text(5) + shared), (3, text(7) + own + text(60) + own + text(9)),
            (4, worn + text(5)), (5, text(8) + worn + text(40) + other + text(6)), (6, ["same"] * 300)]
    found = {}
    out = repeated_passages(docs_of(spark, [(i, " ".join(w)) for i, w in rows])).collect()
    assert sum(r.doc_id == 6 for r in out) <= 10
    for r in out:
        assert (r.source_doc_id, r.source_start) < (r.doc_id, r.start_word)
        found.setdefault(r.doc_id, set()).update(range(r.start_word, r.end_word))
    assert found == {2: {*range(80), *range(110, 190), *range(195, 275)}, 3: set(range(127, 187)), 5: {*range(8, 128), *range(168, 288)}, 6: set(range(50, 300))}


def test_worn_passages_are_found(spark):
    """Recall of passages of 60 words against brute force along the true diagonal, at 80 to 90 % alike."""
    rng = random.Random(14)
    text = lambda n: [str(rng.random()) for _ in range(n)]
    rows, want = [], {}
    for kind in (0.1, 0.15, 0.2, 10, 8, 5):
        for _ in range(12):
            shared, i = text(60), len(rows)
            changed = [j % kind == kind - 1 if kind >= 1 else rng.random() < kind for j in range(60)]
            rows += [(i, text(20) + shared + text(20)), (i + 1, text(33) + [str(rng.random()) if c else w for w, c in zip(shared, changed)] + text(20))]
            good = np.r_[0, np.cumsum(~np.array(changed))]
            if any(good[b] - good[a] >= 0.8 * (b - a) and not changed[a] and not changed[b - 1] for a in range(60) for b in range(a + 50, 61)):
                want[i + 1] = i
    got = {r.doc_id: r.source_doc_id for r in repeated_passages(docs_of(spark, [(i, " ".join(w)) for i, w in rows])).collect()}
    assert len(want) > 55 and got == want


def mixed_rows():
    """Texts of frequent words with exact, worn and repeated passages and stock phrases."""
    rng = random.Random(21)
    pool = [f"w{i}" for i in range(2000)]
    weights = [1 / (i + 2) for i in range(2000)]
    text = lambda n: rng.choices(pool, weights, k=n)
    shared = [text(rng.randrange(50, 120)) for _ in range(6)]
    stock = [text(rng.randrange(4, 30)) for _ in range(5)]
    rows = []
    for i in range(60):
        w = text(rng.randrange(20, 150))
        for _ in range(rng.randrange(4)):
            part = list(rng.choice(shared + stock + stock))
            if rng.random() < 0.4:
                part = [rng.choice(pool) if rng.random() < 0.1 else x for x in part]
            at = rng.randrange(len(w))
            w = w[:at] + part + w[at:]
        rows.append((i, w))
    return rows


def test_hot_seeds_and_small_buckets_give_the_same_passages(spark, monkeypatch):
    rows = mixed_rows()
    docs = docs_of(spark, [(i, " ".join(w)) for i, w in rows]).repartition(3)
    whole = sorted(map(tuple, repeated_passages(docs).collect()))
    found = {}
    for i, a, b, *_ in whole:
        found.setdefault(i, set()).update(range(a, b))
    assert all(words <= found.get(i, set()) for i, words in exact_repeats(rows).items())
    monkeypatch.setattr(passages, "BUCKET_SEEDS", 150)
    monkeypatch.setattr(passages, "SLICE_WORDS", 400)
    assert sorted(map(tuple, repeated_passages(docs).collect())) == whole
    monkeypatch.setattr(passages, "HOT", 6)
    monkeypatch.setattr(passages, "SAMPLE", 1)
    assert sorted(map(tuple, repeated_passages(docs).collect())) == whole


def test_chosen_runs_are_the_least_of_their_neighbours():
    rng = np.random.default_rng(6)
    codes = [rng.integers(0, 9, n).astype(np.uint16) for n in (0, 49, 50, 51, 200, 60)]
    column = pa.array([c.tobytes() for c in codes], pa.binary())
    (_, w), = passages.code_slices(column)
    at, h = passages.chosen_runs(w, 25, 50)
    every, ok = passages.grams(w, 25)
    want = set()
    for a, b in zip(w.first, w.first[1:]):
        for s in range(a, b - 49):
            near = every[s : s + 26]
            want |= {s + int(j) for j in np.flatnonzero(near == near.min())}
    assert set(at.tolist()) == want and (h == every[at]).all() and ok[at].all()


def test_passages_of_ids_of_text_and_of_very_long_texts(spark):
    rng = random.Random(22)
    text = lambda n: [str(rng.random()) for _ in range(n)]
    long, shared = text(70_000), text(80)
    rows = [("b", " ".join(long)), ("a", " ".join(long[40_000:40_300] + text(10))), ("c", " ".join(text(5) + shared)), ("d", " ".join(shared))]
    out = {(r.doc_id, r.source_doc_id, r.start_word, r.end_word, r.source_start) for r in repeated_passages(spark.createDataFrame(rows, "doc_id string, text string")).collect()}
    assert out == {("b", "a", 40_000, 40_300, 0), ("d", "c", 0, 80, 5)}


def test_stretches_cover_what_brute_force_finds():
    rng = np.random.default_rng(4)
    for _ in range(60):
        n = int(rng.integers(20, 160))
        a, b = rng.integers(0, 9, n), rng.integers(0, 9, n)
        copied = np.repeat(rng.random(n // 20 + 1) < 0.7, 20)[:n] & (rng.random(n) < 0.85)
        b[copied] = a[copied]
        at_a, at_b = columns(a, b, [(0, 5, 0)])
        same = a[at_a] == b[at_b]
        got = set()
        for lo, hi in stretches(at_a, at_b, same, 25, 0.8):
            assert hi - lo >= 25 and same[lo:hi].sum() >= 0.8 * (hi - lo) - 1e-6
            got |= set(range(lo, hi))
        runs = np.flatnonzero(same[:-2] & same[1:-1] & same[2:])
        for i in range(n):
            for j in range(i + 25, n + 1):
                if same[i] and same[j - 1] and same[i:j].sum() >= 0.8 * (j - i):
                    inside = runs[(runs >= i) & (runs + 3 <= j)]
                    assert set(range(inside[0], inside[-1] + 3)) <= got


def test_cut_words():
    assert cut_words("one two  three\nfour", [(1, 3)]).split() == ["one", "four"]
    assert cut_words("é ü", [(0, 9), (1, 2)]).strip() == ""


# ------------------------------------------------------------------ archives


def page_rows():
    record = MAGIC + "WARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\nContent-Length: 5\r\n\r\nhello" + RECORD_END
    big = "long payload " * 20
    bodies = ["", None, "short", "short", big, big, "x" + record + "y", record, MAGIC, MAGIC * 40, record * 30, big, "é\r\n\r\n" * 60,
              MAGIC + "Content-Length: 99999999\r\n\r\n", "tail\r\n\r\n" + MAGIC[:-2], record * 30]
    return [(i * 3 % 17, f"http://x/{i}\r\nEvil: 1", b) for i, b in enumerate(bodies)] + [(None, None, "no id"), (None, None, big)]


@pytest.mark.parametrize("block", ["128m", "700b"])
def test_warc_round_trip(spark, block):
    rows = page_rows()
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    try:
        pages = spark.createDataFrame([(*r, "old") for r in rows], "page_id long, url string, html string, record_type string")
        out = round_trip(pages.coalesce(1)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    low = {}
    for i, _, body in rows:
        if body and len(body.encode()) >= 100 and i is not None:
            low[body] = min(i, low.get(body, i))
    want = []
    for i, _, body in rows:
        raw = (body or "").encode()
        again = i is not None and body in low and low[body] != i
        want.append((str(i) if i is not None else None, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", str(low[body]) if again else None))
    got = [(r.record_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in out]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_written_records_have_the_mandatory_fields(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a", "x" * 200), (2, "http://b", "x" * 200), (3, None, None)], "page_id long, url string, html string")
    write_archives(pages.coalesce(1), str(tmp_path / "w"), date=F.lit("2024-05-06 07:08:09").cast("timestamp_ntz"))
    raw = b"".join(p.read_bytes() for p in sorted((tmp_path / "w").glob("part*")))
    heads = [dict(line.split(": ", 1) for line in part.split("\r\n\r\n")[0].split("\r\n") if ": " in line) for part in raw.decode().split(MAGIC)[1:]]
    assert [h["WARC-Type"] for h in heads] == ["response", "revisit", "response"]
    assert all(h["WARC-Date"] == "2024-05-06T07:08:09Z" and h["WARC-Record-ID"] and h["Content-Length"].isdigit() for h in heads)
    assert heads[1]["WARC-Profile"].endswith("identical-payload-digest") and heads[1]["WARC-Refers-To"] == "<urn:page:1>"
    assert heads[0]["Content-Type"].startswith("text/html") and "Content-Type" not in heads[1]


@pytest.mark.parametrize("packed", [False, True])
def test_archives_of_others_are_read(spark, tmp_path, packed):
    import gzip

    body = "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc" + RECORD_END
    records = [
        ("WARC/1.1\r\nwarc-type: warcinfo\r\nwarc-record-id: <urn:uuid:1>\r\nCONTENT-LENGTH:4\r\n\r\ninfo"),
        (f"WARC/1.1\r\nWARC-Type:  response\r\nWARC-Record-Id: <urn:uuid:2>\r\ncontent-length: {len(body)}\r\n\r\n{body}"),
        ("WARC/1.0\r\nWARC-Type: revisit\r\nWARC-Record-ID: <urn:uuid:3>\r\nWARC-Refers-To: <urn:uuid:2>\r\nWARC-Payload-Digest: sha1:ABC\r\nContent-Length: 0\r\n\r\n"),
        ("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:7>\r\nContent-Length: 5\r\n\r\nhello")]
    raw = [(r + RECORD_END).encode() for r in records]
    folder = tmp_path / "foreign"
    folder.mkdir()
    (folder / ("a.warc.gz" if packed else "a.warc")).write_bytes(b"".join(map(gzip.compress, raw)) if packed else b"".join(raw))
    got = {r.record_id: (r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) for r in read_archives(spark, str(folder)).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert got == {"urn:uuid:1": ("warcinfo", None, 4, sha("info")), "urn:uuid:2": ("response", None, len(body), sha(body)),
                   "urn:uuid:3": ("revisit", "urn:uuid:2", None, "sha1:ABC"), "7": ("resource", None, 5, sha("hello"))}


def test_archives_of_no_pages(spark, tmp_path):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    write_archives(empty, str(tmp_path / "none"))
    assert read_archives(spark, str(tmp_path / "none")).count() == 0


# ------------------------------------------------------------------ mixtures


def poured(caps, weights, given):
    """Share out step by step: what a full child leaves goes to the others by weight."""
    got = {k: 0.0 for k in caps}
    free = {k for k in caps if weights[k] > 0}
    while free and given > 1e-9:
        total = sum(weights[k] for k in free)
        full = {k for k in free if caps[k] <= given * weights[k] / total + 1e-12}
        if not full:
            for k in free:
                got[k] = given * weights[k] / total
            break
        for k in full:
            got[k] = caps[k]
            given -= caps[k]
        free -= full
    return got


@pytest.mark.parametrize("share, epochs", [(0.4, 1), (1.0, 1), (1.7, 3), (9.0, 2)])
def test_mixing(spark, share, epochs):
    rng = random.Random(9)
    rows = []
    for i in range(300):
        source = "s0" if i % 3 == 0 else f"s{rng.randrange(1, 6)}"
        rows.append((i, " ".join("w" * 1 for _ in range(rng.randrange(0, 30))) if i % 50 else None, rng.choice(["en", "de", None]), source, 5))
    rows.append(rows[10])
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, epoch int")
    levels = {"domain": F.when(F.col("source") < "s3", "a").otherwise("b"), "lang": F.col("lang"), "source": F.col("source")}
    weights = {"domain": {"a": 0.3, "b": 0.7}, "lang": {"de": 3.0, "(none)": 0.5}, "source": {"s5": 0.0}}
    out = mixed(docs, levels, weights, share, epochs, seed=4).collect()

    leaf_of = lambda r: ("a" if r[3] < "s3" else "b", r[2] or "(none)", r[3])
    n = lambda r: len((r[1] or "").split())
    leaves = {}
    for r in rows:
        leaves.setdefault(leaf_of(r), []).append(r)
    tokens = {k: sum(map(n, v)) for k, v in leaves.items()}
    budgets = {(): min(round(share * sum(tokens.values())), epochs * sum(tokens.values()))}
    for d, level in enumerate(levels):
        below = {}
        for path, given in budgets.items():
            caps = {}
            for k in tokens:
                if k[:d] == path:
                    caps[k[d]] = caps.get(k[d], 0) + epochs * tokens[k]
            got = poured(caps, {c: weights[level].get(c, 1.0) for c in caps}, given)
            below |= {(*path, c): v for c, v in got.items()}
        budgets = below
    want = []
    for k, docs_in in leaves.items():
        budget = round(budgets[k])
        whole = budget // tokens[k] if tokens[k] else 0
        rest = budget - whole * tokens[k]
        want += [(r[0], *k, n(r), e) for r in docs_in for e in range(whole)]
        total = 0
        for r in sorted(docs_in, key=lambda r: (hashlib.md5(f"4:{whole}:{r[0]}".encode()).hexdigest(), n(r))):
            total += n(r)
            if rest and total <= rest:
                want.append((r[0], *k, n(r), whole))
    got = [(r.doc_id, r.domain, r.lang, r.source, r.n_tokens, r.epoch) for r in out]
    assert sorted(got) == sorted(want)
    carried = mixed(docs, levels, weights, share, epochs, seed=4, carry=True)
    assert carried.columns == ["doc_id", "text", "lang", "source", "epoch"]
    assert sorted((r.doc_id, r.epoch) for r in carried.collect()) == sorted((w[0], w[-1]) for w in want)


def test_mixing_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert mixed(docs, {"lang": F.col("lang")}, {}).count() == 0
