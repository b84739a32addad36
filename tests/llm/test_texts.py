"""Operators on documents against brute force, and on odd and empty tables."""

import collections
import hashlib
import random
import re
import string

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from roadpulse.llm import batches, decontaminate, language_id, line_dedup, minhash, pieces, secret_scan, substring_dedup

from . import cases


def spread(*rows):
    return sorted(rows, key=repr)


@pytest.fixture(scope="module")
def docs(spark):
    return cases.documents(spark).repartition(3).cache()


@pytest.fixture(scope="module")
def folder(spark, docs, tmp_path_factory):
    place = str(tmp_path_factory.mktemp("tables"))
    docs.write.parquet(f"{place}/documents.parquet")
    base = cases.texts()[0]
    items = [(1, " ".join(base.split()[20:50])), (2, " ".join(base.split()[30:45])), (3, "two words"), (4, None), (5, "..."), (10, cases.prose(77, 30))]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{place}/benchmark.parquet")
    return place


def test_decontamination(spark, folder, docs):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    words = lambda t: word.findall((t or "").translate(cases.LOWER))
    windows = collections.defaultdict(set)
    for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect():
        w = words(r.text)
        for k in range(max(1, len(w) - 12) if w else 0):
            windows[tuple(w[k : k + 13])].add(r.item_id)
    expected = []
    for r in docs.collect():
        w, hit, items = words(r.text), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if found := windows.get(tuple(w[k : k + n])):
                    hit.update(range(k, k + n))
                    items |= found
        names = ",".join(sorted(map(str, items)))
        expected.append((r.doc_id, len(w), len(hit), len(items), hashlib.sha256(names.encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(w)))
    got = [tuple(r) for r in decontaminate.op2_benchmark_decontamination(spark, folder).collect()]
    assert sorted(got) == sorted(expected)
    assert any(r[5] for r in got) and sum(r[3] > 1 for r in got)
    small = decontaminate.find_hits(docs, spark.read.parquet(f"{folder}/benchmark.parquet"), most_broadcast=0)
    assert sorted((r["__id"], r.n_hit) for r in small.collect()) == sorted((r[0], r[2]) for r in expected)
    left = decontaminate.remove_spans(docs, spark.read.parquet(f"{folder}/benchmark.parquet"))
    assert left.columns == docs.columns and left.count() == docs.count()
    again = decontaminate.find_hits(left.filter("doc_id = 0"), spark.read.parquet(f"{folder}/benchmark.parquet"))
    assert again.first().n_hit == 0
    assert {r.doc_id for r in decontaminate.remove_documents(docs, spark.read.parquet(f"{folder}/benchmark.parquet")).collect()} == {r[0] for r in expected if not r[5]}


def test_substrings(spark, docs, folder):
    rows = docs.collect()
    words = {r.doc_id: (r.text or "").encode().split() for r in rows}
    for length in (35, 5, 16):
        seen = collections.Counter(tuple(w[k : k + length]) for w in words.values() for k in range(len(w) - length + 1))
        expected = []
        for i, w in words.items():
            gone = {p for k in range(len(w) - length + 1) if seen[tuple(w[k : k + length])] > 1 for p in range(k, k + length)}
            expected.append((i, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
        got = substring_dedup.remove_repeats(docs, length=length, chunk_bytes=20_000).select("doc_id", "n_words", "n_removed", "kept")
        assert sorted(map(tuple, got.collect())) == sorted(expected)
    assert substring_dedup.levels(35) == [9, 18, 35] and substring_dedup.levels(5) == [5]
    assert substring_dedup.op6_substring_dedup(spark, folder).columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]


def linked(sets, least=80):
    up = {k: k for k in sets}

    def root(k):
        while up[k] != k:
            k = up[k]
        return k

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= least * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {k: root(k) for k in sets}


def test_near_duplicates(spark, docs, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_ROWS", 2)  # blocks of a cluster meet as well
    for n in (2, 5):
        sets = {}
        for r in docs.collect():
            w = (r.text or "").translate(cases.LOWER).encode().split()
            sets[r.doc_id] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()
        roots = linked(sets)
        got = minhash.near_duplicates(docs, words=n).select("doc_id", "n_shingles", "component_id", "kept").collect()
        assert sorted(map(tuple, got)) == sorted((k, len(s), roots[k], roots[k] == k) for k, s in sets.items())


def test_near_duplicates_beside_a_template(spark, monkeypatch):
    monkeypatch.setattr(minhash, "REST_ROWS", 3)  # blocks of a bucket meet as well
    template = [f"t{k}" for k in range(60)]
    rows = []
    for k in range(400):  # a page frame and words of their own: similarity 0.3 to each other
        own = template + [f"{k // 2 if k < 120 else k}w{n}" for n in range(70)]
        rows.append((k, " ".join(own + [f"{k}x{n}" for n in range(10)] if k < 120 else own)))
    sets = {k: {tuple(w[n : n + 2]) for n in range(len(w) - 1)} for k, w in ((k, t.encode().split()) for k, t in rows)}
    roots = linked(sets)
    assert sum(roots[k] != k for k in roots) == 60
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    # one band of one minimum that all share: every node is in the hub's bucket
    monkeypatch.setattr(minhash, "signatures", one_bucket(minhash.signatures))
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs, words=2).collect()}
    assert got == roots


def test_null_ids_are_linked(spark):
    w = [f"w{k}" for k in range(100)]
    bridge = [w[:94], w[3:97], w[6:]]  # the ends are linked by the one in the middle only
    rows = [(5, " ".join(bridge[0]))] + [(None, " ".join(bridge[1]))] * 2 + [(7, " ".join(bridge[2])), (None, "one two"), (9, " ".join(w[:40]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id or 0, r.component_id, r.kept) for r in minhash.near_duplicates(docs, words=2, percent=90).collect()), key=repr)
    assert got == sorted([(5, 5, True), (0, 5, False), (0, 5, False), (7, 5, False), (0, None, False), (9, 9, True)], key=repr)


def one_bucket(signatures):
    return lambda *a: signatures(*a).withColumn("__bands", F.when(F.col("__bands").isNotNull(), F.array(F.lit(1).cast("long"))))


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_banded_distance():
    draw = np.random.default_rng(5)
    for edits in (1, 2, 3):
        lines = []
        for _ in range(150):
            s = draw.choice(list("ab é"), draw.integers(6, 30)).tolist()
            t = list(s)
            for _ in range(draw.integers(0, edits + 2)):
                k = int(draw.integers(len(t)))
                t[k : k + int(draw.integers(2))] = [str(draw.choice(list("abc")))] * int(draw.integers(2))
            lines += ["".join(s), "".join(t)]
        codes, sizes = line_dedup._codes(lines)
        pairs = [(i, i + 1) if sizes[i] >= sizes[i + 1] else (i + 1, i) for i in range(0, 300, 2)]
        got = line_dedup.distances(codes, sizes, *np.array(pairs).T, edits)
        assert got.tolist() == [min(distance(lines[a], lines[b]), edits + 1) for a, b in pairs]


def test_lines(spark, docs, monkeypatch):
    monkeypatch.setattr(line_dedup, "BLOCK_ROWS", 3)
    places = collections.defaultdict(list)
    for r in docs.collect():
        for k, line in enumerate((r.text or "").split("\n")):
            if len(line) >= line_dedup.LEAST:
                places[line].append((r.doc_id, k))
    lines, up = list(places), {}
    for i, a in enumerate(lines):
        for b in lines[:i]:
            if abs(len(a) - len(b)) <= 2 and distance(a, b) <= 2:
                up.setdefault(a, set()).add(b)
                up.setdefault(b, set()).add(a)
    expected, done = collections.defaultdict(list), set()
    for line in lines:
        if line in done:
            continue
        whole, todo = set(), [line]
        while todo:
            if (x := todo.pop()) not in whole:
                whole.add(x)
                todo += up.get(x, ())
        done |= whole
        for doc, k in sorted(p for x in whole for p in places[x])[1:]:
            expected[doc].append(k)
    got = {r["__id"]: r.removed for r in line_dedup.removed_lines(docs).collect()}
    assert got == {d: sorted(k) for d, k in expected.items()} and up
    left = {r.doc_id: r.text for r in line_dedup.remove_lines(docs).collect()}
    for r in docs.collect():
        kept = [x for k, x in enumerate((r.text or "").split("\n")) if k not in expected[r.doc_id]]
        assert left[r.doc_id] == (None if r.text is None else "\n".join(kept))


def test_equal_short_lines(spark, folder):
    short, long = "Ment que.", "A line of well over twenty characters."
    text = f"{short}\n{long}\n\nEnd."
    rows = [(1, text, "en", "s", 0), (2, text, "en", "s", 0), (3, f"{long} \n{short}\n\nMent qua.", "en", "s", 0)]
    docs = cases.documents(spark, rows)
    assert {r["__id"]: r.removed for r in line_dedup.removed_lines(docs).collect()} == {2: [0, 1, 3], 3: [0, 1]}
    left = {r.doc_id: r.text for r in corpus_pipeline.remove_repeated_lines(spark, docs, folder).collect()}
    assert left == {1: text, 3: "\nMent qua."}


def test_languages(spark):
    rows = [(k, cases.prose(k % 2 + 1, 80), ("aa", "bb")[k % 2], "s", 0) for k in range(40)] + [(90, "12 …", "aa", "s", 0), (91, None, "bb", "s", 0), (92, "", None, "s", 0), (93, cases.prose(1, 50), None, "s", 0)]
    docs = cases.documents(spark, rows)
    profiles = language_id.learn(docs)
    got = {r.doc_id: r for r in language_id.predict(docs, profiles).collect()}
    assert all(got[k].lang_pred == ("aa", "bb")[k % 2] and 0 < got[k].score <= 1 for k in range(40))
    assert [got[k].lang_pred for k in (90, 91, 92, 93)] == ["und", "und", "und", "aa"] and got[91].score == 0
    # the profile is the sum over all texts of the products of rotated letter vectors
    expected = np.zeros(language_id.DIMENSIONS)
    v = lambda c: language_id.letter_vector(0 if c == " " else ord(c), language_id.DIMENSIONS).astype(int)
    for _, text, lang, *_ in rows:
        if lang == "aa" and text:
            spaced = " " + re.sub(r"[^\W\d_]+|[\W\d_]+", lambda m: m[0] if m[0][0].isalpha() else " ", text.lower()).strip() + " "
            for a, b, c in zip(spaced, spaced[1:], spaced[2:]):
                if b != " ":
                    expected += np.roll(v(a), 2) * np.roll(v(b), 1) * v(c)
    assert np.array_equal(profiles["aa"], expected)
    assert {r.lang_pred for r in language_id.predict(docs, language_id.learn(cases.empty(spark))).collect()} == {"und"}


def test_pieces(spark, docs):
    model = open(pieces.MODEL, "rb").read()
    coder = pieces.Pieces(model)
    score = {}
    for number, value in pieces._fields(model):
        if number == 1:
            f = dict(pieces._fields(value))
            if f.get(3, 1) == 1:
                score[f[1].decode()] = np.frombuffer(f.get(2, b"\0" * 4), "<f4")[0].item()
    for text in ["then the with", "über 日本 🎉 x", "aaaaaaa", "a  b", "\n\na", "…"]:
        part = coder.normal(text)
        best = [0.0] + [None] * len(part)
        for end in range(1, len(part) + 1):
            tried = [best[s] + score[part[s:end]] for s in range(end) if part[s:end] in score]
            if part[end - 1] not in score:
                tried.append(best[end - 1] + coder.unknown_score)
            best[end] = max(tried)
        total, run = 0.0, 0
        for k in coder.encode(text):
            if k in coder.bytes.values():
                run += 1
            else:
                total += score[coder.pieces[k]]
        unknown = sum(c not in score for c in part)
        assert total + unknown * coder.unknown_score == pytest.approx(best[-1]) and run == sum(len(c.encode()) for c in part if c not in score)
        assert coder.decode(coder.encode(text)) == text
    assert {r.round_trip for r in pieces.encode_and_check(docs, model).collect()} == {True}
    assert coder._of_pieces("▁then") == coder._with_unknown("▁then") == coder.best("▁then")
    texts = [cases.prose(seed, 200, 300) for seed in range(30)]
    whole = [coder.encode(t) for t in texts]
    before, pieces.MOST_KEPT = pieces.MOST_KEPT, 50  # both tables fill over and over
    try:
        small = pieces.Pieces(model)
        assert [small.encode(t) for t in texts] == whole and len(small.kept) <= 50 and len(small.older) <= 50
    finally:
        pieces.MOST_KEPT = before
    got = pieces.decode(pieces.encode(docs, model), model).collect()
    assert all(r.decoded == r.text and (r.ids is None) == (r.text is None) for r in got)


def test_secrets(spark):
    key = "Zk8Qw3RtY7uPl0aXvB2nGh5"
    rows = [(1, f'é password = "{key}" and token: abc'), (2, "AKIA" + "A1" * 8 + " AKIASHORT"), (3, "x " + "0a" * 12 + " " + "0a" * 11),
            (4, f"the bearer {key} here"), (5, f"the harbour {key} here"), (6, "bearer getUserNameFromConfig2Handler"), (7, None), (8, ""), (9, "password=token:abcdefgh")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in secret_scan.scan(docs).collect()}
    assert got[1] == [("assign", 2, 14 + len(key))] and got[2] == [("access", 0, 20)] and got[3] == [("hex", 2, 26)]
    assert got[4] == [("novel", 11, 11 + len(key))] and not any(got[k] for k in (5, 6, 7, 8, 9))


def test_recall_of_planted_secrets():
    """Random strings at many places of prose, on both sides of a word that announces them, by kind; and what is none."""
    letters, draw, novelty = string.ascii_letters, random.Random(5), secret_scan.Novelty(secret_scan.IDENTIFIERS)
    texts = [cases.prose(seed, 300, 400) for seed in range(20)]
    kinds = {"base62": letters + string.digits, "HEX": "0123456789ABCDEF", "lower": string.ascii_lowercase, "letters": letters, "base32": string.ascii_uppercase + "234567"}

    def found(secret, before):
        text = draw.choice(texts)
        place = text.index(" ", draw.randrange(len(text) - 200))
        text = text[:place] + (f" {secret} is the bearer" if before else f" bearer {secret}") + text[place:]
        start = text.index(secret)
        return (start, 3, start + len(secret)) in secret_scan.novel_spans(text, [], novelty, secret_scan.NOVELTY)

    for kind, alphabet in kinds.items():
        for size in (20, 32, 40):
            hits = [found("".join(draw.choice(alphabet) for _ in range(size)), k % 2) for k in range(60)]
            assert sum(hits) / len(hits) >= 0.9, (kind, size)
    names = ["getUserNameFromConfig2Handler", "authenticationTokenProvider", "org/apache/commons/lang/functions", "client_secret_key_name", "password_reset_template_path"]
    hits = [found(name, k % 2) for name in names for k in range(10)]
    assert sum(hits) / len(hits) <= 0.2
    assert not secret_scan.novel_spans("bearer " + "=" * 40 + " " + "ab" * 20, [], novelty, secret_scan.NOVELTY)


def test_base_spans_by_plain_search(spark, docs):
    patterns = [(r"""(?ia:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""", 6), ("AKIA[A-Z0-9]+", 20), ("[0-9a-f]+", 24)]
    rows = {r.doc_id: r.text or "" for r in docs.collect()}
    rows |= {100: "x password: hunter2 TOKEN='abc' api_key=abc.def+", 101: "AKIA" * 6 + " " + "ab" * 14 + "g" + "01" * 12, 102: "secretsecret=  \"abcdefg\" apikey:token:abcdefgh"}
    table = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    got = {r.doc_id: [(s.start, s.kind, s.end) for s in r.spans if s.kind != "novel"] for r in secret_scan.scan(table).collect()}
    for id, text in rows.items():
        spans = [(m.start(), k, m.end()) for k, (p, least) in enumerate(patterns) for m in re.finditer(p, text) if len(m[2] if k == 0 else m[0]) >= least]
        assert got[id] == [(a, secret_scan.KINDS[k], b) for a, k, b in sorted(spans)], id


@pytest.mark.parametrize("table", ["odd", "empty"])
def test_odd_and_empty_tables(spark, folder, table):
    docs = getattr(cases, table)(spark)
    n = docs.count()
    benchmark = spark.read.parquet(f"{folder}/benchmark.parquet")
    model = pieces.read_model(spark)
    assert len(decontaminate.remove_spans(docs, benchmark).collect()) == n
    assert decontaminate.find_hits(docs, benchmark.limit(0)).filter("n_hit > 0").count() == 0
    assert len(decontaminate.remove_documents(docs, benchmark).collect()) == n - (3 if n else 0)
    assert len(substring_dedup.remove_repeats(docs).collect()) == n
    near = minhash.near_duplicates(docs).collect()
    assert len(near) == n and (not n or [r.component_id for r in near if r.doc_id == 1] == [1, 1])
    assert len(line_dedup.remove_lines(docs).collect()) == n
    assert len(language_id.predict(docs, language_id.learn(docs)).collect()) == n
    assert len(secret_scan.scan(docs).collect()) == n
    coded = pieces.decode(pieces.encode(docs, model), model)
    assert coded.filter(~F.col("decoded").eqNullSafe(F.col("text"))).count() == 0 and coded.count() == n


def test_a_row_for_each_document(spark, folder, tmp_path):
    repeated = cases.documents(spark).limit(4)
    repeated.unionByName(repeated.filter("doc_id < 2")).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{folder}/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = [r.doc_id for r in decontaminate.op2_benchmark_decontamination(spark, str(tmp_path)).collect()]
    assert sorted(got) == [0, 0, 1, 1, 2, 3]


def test_hashes_of_runs_by_plain_sums():
    rng = np.random.default_rng(2)
    data = rng.integers(0, 256, 300_000, dtype=np.uint8)
    starts, ends = np.array([0, 5, 9, 30, 200_000]), np.array([5, 9, 9, 200_000, 300_000])
    base = batches._BASES[1]

    def plain(values):
        total, power = 0, 1
        for v in values:
            total, power = (total + (int(v) + 1) * power) % 2**64, power * base % 2**64
        return total

    expected = batches.mixed(np.array([plain(data[a:b]) for a, b in zip(starts, ends)], np.uint64))
    assert (batches.ranges(data, starts, ends, 2, plus=1) == expected).all()
    words = rng.integers(0, 2**63, 50).astype(np.uint64)
    for length in (1, 2, 3, 7, 35, 50, 51):
        n = max(0, 50 - length + 1)
        each = batches.ranges(words, np.arange(n), np.arange(n) + length, 4)
        assert (batches.windows(words, length, 4) == each).all() and len(each) == n


@pytest.mark.parametrize("table", ["odd", "empty"])
def test_pipeline_on_odd_and_empty_tables(spark, folder, table):
    now = getattr(cases, table)(spark)
    for name, stage in corpus_pipeline.STAGES:
        before, now = now, stage(spark, now, folder).cache()
        assert name == "sentencepiece" or now.columns == before.columns
    assert now.count() == (1 if table == "odd" else 0)  # the other texts hold a benchmark passage, or none at all


def test_languages_in_the_pipeline(spark, folder, docs):
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert corpus_pipeline.identify_language(spark, unlabelled, folder).count() == docs.count()
    filled = corpus_pipeline.identify_language(spark, docs, folder)
    assert filled.filter("lang is null").count() == 0
    assert {r.doc_id: r.lang for r in docs.filter("lang is not null").collect()}.items() >= {r.doc_id: r.lang for r in filled.collect() if r.doc_id % 3 < 2}.items()


def test_columns_of_the_user_stay(spark, folder, docs):
    marked = docs.withColumn("was_blank", F.lit("mine")).drop("n_chars")
    rows = corpus_pipeline.remove_repeated_lines(spark, marked, folder)
    assert rows.columns == marked.columns and {r.was_blank for r in rows.collect()} == {"mine"}


def test_pipeline(spark, docs, folder):
    seen, now = [], docs
    for _, stage in corpus_pipeline.STAGES:
        before, now = now, stage(spark, now, folder).cache()
        seen.append({r.doc_id: r for r in now.collect()})
        if stage is not corpus_pipeline.STAGES[-1][1]:
            assert now.columns == before.columns
    languages, lines, near, clean, coded = seen
    assert set(languages) == {r.doc_id for r in docs.collect() if any(c.isalpha() for c in r.text or "")}
    assert 1 not in lines and lines[0].text == languages[0].text  # an exact copy has no line left
    w = {k: r.text.translate(cases.LOWER).encode().split() for k, r in lines.items()}
    roots = linked({k: {tuple(x[i : i + 5]) for i in range(len(x) - 4)} if len(x) >= 5 else {tuple(x)} if x else set() for k, x in w.items()})
    assert set(near) == {k for k, r in roots.items() if r == k}
    assert 0 in near and 0 not in clean and set(clean) == set(coded)
    assert all(r.round_trip for r in coded.values())
    assert corpus_pipeline.run(spark, folder).count() == len(coded)
