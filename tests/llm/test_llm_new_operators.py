"""Toxicity, tokenizer alignment and vector codes on small frames, against plain versions of the same rules."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import alignment, queries, toxicity, vector_codes
from tallyloom.llm.common import read
from tallyloom.llm.token_counts import tokenizer_path

# 11 toxicity


def area(scores, labels):
    good = [s for s, y in zip(scores, labels) if not y]
    bad = [s for s, y in zip(scores, labels) if y]
    return sum((b > g) + 0.5 * (b == g) for g in good for b in bad) / (len(good) * len(bad))


def plain_savings(model, text):
    """A window at a time, by compressors made for each."""
    folded = "".join(c.lower() if "A" <= c <= "Z" else c if "a" <= c <= "z" or ord(c) > 127 else " " for c in text or "")
    words = folded.encode().split(b" ")
    words = [w for w in words if w]
    out = []
    for at in range(0, len(words), 10):
        window = b" " + b" ".join(words[at : at + 10]) + b" "
        out.append(int(toxicity.Compressor(model.ordinary).lengths([window])[0] - toxicity.Compressor(model.toxic).lengths([window])[0]))
    return out


@pytest.fixture(scope="module")
def toxic_model(spark):
    docs, labels = read(spark, "/root/testdata/sf0.1", "documents"), read(spark, "/root/testdata/sf0.1", "labels")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0
    return toxicity.learn(docs, labels, ~held)


def test_toxicity_on_held_out_labels(spark, toxic_model):
    docs, labels = read(spark, "/root/testdata/sf0.1", "documents"), read(spark, "/root/testdata/sf0.1", "labels")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0
    found = toxicity.score(docs, toxic_model).join(labels.where(held), "doc_id").collect()
    english = {r.doc_id for r in docs.where("lang = 'en'").select("doc_id").collect()}
    assert area([r.score for r in found], [r.toxic for r in found]) > 0.85
    assert area(*zip(*[(r.score, r.toxic) for r in found if r.doc_id in english])) > 0.9
    assert sum(r.predicted for r in found if not r.toxic) < 0.03 * len(found)


def test_savings_equal_windows_compressed_one_by_one(spark, sf_dir, toxic_model):
    texts = [r.text for r in read(spark, sf_dir, "documents").limit(25).collect()] + ["", None, "One IDIOT. two-three é", "1 2 3"]
    for text in texts:
        windows = toxicity.windows_of(toxicity.words_of(text))
        assert toxic_model.savings(windows).tolist() == plain_savings(toxic_model, text)
    features = toxic_model.features(texts)
    for text, row in zip(texts, features):
        saved = plain_savings(toxic_model, text)
        counted = sum(s >= toxic_model.threshold for s in saved)
        assert row[0] == min(max([0, *saved]), 16) / 4 and row[1] == pytest.approx(np.log1p(counted))
        assert row[2] == pytest.approx(4 * (counted / max(len(saved), 1)) ** 0.5)


def test_scores_do_not_depend_on_pieces(monkeypatch, toxic_model):
    text = " ".join(f"word{i % 37} idiot" if i % 50 == 0 else f"some{i % 91}" for i in range(5000))
    whole = toxic_model.features([text, "a b", text])
    monkeypatch.setattr(toxicity, "_PIECE_BYTES", 300)
    assert np.array_equal(toxic_model.features([text, "a b", text]), whole)


def test_toxicity_of_odd_rows_and_labels(spark, toxic_model):
    rows = [(1, None), (2, ""), (3, "\n \t"), (None, "you pathetic idiot, worthless trash"), (4, "x" * 300_000), (4, "a b"), (4, "a b")]
    docs = spark.createDataFrame([(*row, 0.3, 5, True) for row in rows], "doc_id long, text string, score double, predicted int, held_out boolean")
    found = toxicity.score(docs, toxic_model, F.lit(True).alias("held_out")).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in found)
    assert {r.score for r in found if r.doc_id in (1, 2, 3)} == {found[0].score}
    assert [r.predicted for r in found if r.doc_id is None] == [1]
    assert toxicity.score(docs.limit(0), toxic_model).count() == 0
    schema = "doc_id long, quality int, toxic int"
    for labels, score in (([], 0.5), ([(4, 1, None), (None, 1, 1)], 0.5), ([(4, 0, 0), (2, 0, 0)], 0.0), ([(4, 0, 0), (4, 0, 1)], 1.0)):
        model = toxicity.learn(docs, spark.createDataFrame(labels, schema), F.lit(True))
        assert {r.score for r in toxicity.score(docs, model).collect()} == {score}


def test_fitting_sample_is_bounded(spark):
    docs = spark.range(3000).selectExpr("id % 1000 AS doc_id", "repeat(concat('w', id), 50) AS text")
    labels = spark.range(1000).selectExpr("id AS doc_id", "id % 5 = 0 AS label", "id % 5 = 0 AS stratum")
    from tallyloom.llm.common import bounded_texts

    rows = bounded_texts(docs, labels, 60, 1 << 20)
    assert Counter(r.label for r in rows) == {True: 60, False: 60} and len({r.doc_id for r in rows}) == 120
    few = bounded_texts(docs, labels, 60, 40_000)
    assert 0 < sum(len(r.text) for r in few) <= 40_000


# 12 alignment

TEXTS = [
    None, "", " ", "  two  blanks ", "x▁y", "<|endoftext|> </s> <unk>", "a bﬁ　\x00z", "日本語 текст ملف", "don't won't 12,345.67",
    "é é", "🙂🙂", "\n\n\ttabs", "supercalifragilistic", "A" * 5000, "the the the",
]


def plain_alignment(texts):
    """Tokens, groups and links of each text, token by token, from the libraries' own encoders."""
    import sentencepiece
    from tokenizers import Tokenizer

    a_tokenizer = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    a_tokenizer.encode_special_tokens = True
    b_tokenizer = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    alphabet = alignment._byte_alphabet()
    out = []
    for text in texts:
        a = b = []
        if text:
            a, b = a_tokenizer.encode(" " + text, add_special_tokens=False).ids, b_tokenizer.encode(text)
            spelled_a = [bytes(alphabet[c] for c in a_tokenizer.id_to_token(i)) for i in a]
            pieces = [b_tokenizer.id_to_piece(i) for i in b]
            spelled_b = [bytes([int(p[3:-1], 16)]) if b_tokenizer.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, pieces)]
            raw = (" " + text).encode()
            if b"".join(spelled_a) != raw or b"".join(spelled_b) != raw:
                a = b = []
        ends_a = np.cumsum([len(s) for s in spelled_a]).tolist() if a else []
        ends_b = np.cumsum([len(s) for s in spelled_b]).tolist() if a else []
        groups, links, i, j = [], Counter(), 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            x, y = i, j
            while i < len(a) and ends_a[i] <= end:
                i += 1
            while j < len(b) and ends_b[j] <= end:
                j += 1
            groups.append(",".join(map(str, a[x:i])) + "|" + ",".join(map(str, b[y:j])))
            for p in range(x, i):
                for q in range(y, j):
                    if max([0, *ends_a][p], [0, *ends_b][q]) < min(ends_a[p], ends_b[q]):
                        links[a[p], b[q]] += 1
        out.append((len(a), len(b), ";".join(groups), links))
    return out


def test_gallop_equals_binary_search():
    rng = random.Random(1)
    for _ in range(300):
        top = rng.choice([3, 50, 4000])
        short, long = (np.array(sorted(rng.sample(range(1, top + 1), rng.randrange(0, min(top, 300) + 1))), dtype=np.int64) for _ in range(2))
        assert np.array_equal(alignment.gallop(short, long), np.searchsorted(long, short))


def test_byte_level_runs_equal_the_library():
    from tokenizers import Tokenizer

    path = tokenizer_path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    ours = alignment.byte_level_encoder(path)
    assert ours.lossless
    for low in range(0, 0x110000, 0x4000):
        some = [f"a{c}b {c}{c} 1{c}2 {c}  {c}'s\n{c} {c}" for c in map(chr, range(low, low + 0x4000)) if not 0xD800 <= ord(c) < 0xE000]
        theirs = [one.ids for one in tokenizer.encode_batch([" " + t for t in some], add_special_tokens=False)]
        assert ours.encode(some) == theirs


@pytest.mark.parametrize("hot_pairs", [1_500_000, 200, 0])
def test_alignment_equals_plain_groups_links_and_counts(spark, sf_dir, hot_pairs):
    texts = TEXTS + [r.text for r in read(spark, sf_dir, "documents").limit(40).collect()] + TEXTS[:4]
    rows = [(None if i % 7 == 0 else i, text, "x", i) for i, text in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, groups string, n_a int")
    plain = plain_alignment(texts)
    holding = Counter(pair for *_, links in plain for pair in links)
    best = {}
    for (a, _), n in holding.items():
        best[a] = max(n, best.get(a, 0))
    expected = []
    for (doc_id, *_), (n_a, n_b, groups, links) in zip(rows, plain):
        n_best = sum(n for pair, n in links.items() if holding[pair] == best[pair[0]])
        count_sum = sum(n * holding[pair] for pair, n in links.items())
        n_groups = groups.count(";") + 1 if groups else 0
        expected.append((doc_id, n_a, n_b, n_groups, sum(links.values()), groups, n_best, count_sum))
    found = alignment.with_counts(alignment.aligned(docs), hot_pairs)
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum"]
    assert sorted(map(str, (tuple(r) for r in found.select(*names).collect()))) == sorted(map(str, expected))


def test_chunks_make_no_difference(monkeypatch):
    pair = alignment.Pair(tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))
    whole, single = pair.chunk(TEXTS), [pair.chunk([text]) for text in TEXTS]
    for name in ("n_a", "n_b", "n_groups", "n_links", "groups"):
        assert [one[name][0] for one in single] == list(whole[name])


def test_alignment_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.with_counts(alignment.aligned(docs)).count() == 0


# 13 vector codes


def plain_codes(vectors, parts, entries, rounds):
    """Full scans over Python integers. Vectors are (vec_id, components); all of one length."""
    cut = [[v[p * len(v) // parts : (p + 1) * len(v) // parts] for p in range(parts)] for _, v in vectors]
    order = sorted(range(len(vectors)), key=lambda i: (vectors[i][0] is None, vectors[i][0] or 0, vectors[i][1]))
    books = [[cut[i][p] for i in order[:entries]] for p in range(parts)]

    def nearest(x, book):
        d = [sum((a - b) ** 2 for a, b in zip(x, entry)) for entry in book]
        return d.index(min(d)), min(d)

    for _ in range(rounds):
        for p in range(parts):
            members = [[] for _ in books[p]]
            for row in cut:
                members[nearest(row[p], books[p])[0]].append(row[p])
            books[p] = [[sum(c) // len(own) for c in zip(*own)] if own else old for own, old in zip(members, books[p])]
    found = [[nearest(row[p], books[p]) for p in range(parts)] for row in cut]
    return ["".join(f"{e:02x}" for e, _ in one) for one in found], [sum(d for _, d in one) for one in found], books


@pytest.mark.parametrize("entries, rounds, scale", [(256, 4, 1.0), (7, 6, 1.0), (16, 4, 30_000.0), (3, 0, 1.0)])
def test_codes_equal_full_scans(spark, entries, rounds, scale):
    rng = random.Random(entries)
    rows = []
    for i in range(300):
        # few values, so that distances tie and parts repeat
        vector = [rng.choice([-1.0, -0.5, 0.001, 0.5, 1.0]) * scale for _ in range(8)]
        rows.append((None if i % 50 == 0 else rng.randrange(200), vector, rng.choice([None, 1, 2, 2, 2])))
    dropped = [(1, None, 1), (2, [0.1] * 7 + [None], 1), (3, [float("nan")] + [0.0] * 7, 2), (4, [float("-inf")] * 8, 2)]
    frame = spark.createDataFrame([(*row, "x", 1) for row in rows + dropped], "vec_id long, embedding array<double>, label int, code string, error int")
    vectors = [(i, [int(np.floor(1024 * x)) for x in v]) for i, v, _ in rows]
    codes, errors, books = plain_codes(vectors, 4, entries, rounds)
    found, codebooks = vector_codes.coded(frame.repartition(5), 4, entries, rounds)
    assert codebooks.tolist() == books
    by_label = Counter()
    for (_, _, label), error in zip(rows, errors):
        by_label[label] += error
    expected = [(i, label, code, error, by_label[label]) for (i, _, label), code, error in zip(rows, codes, errors)]
    got = vector_codes.with_label_error(found).select("vec_id", "label", "code", "error", "label_error").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))


def test_only_moved_entries_are_compared(monkeypatch):
    rng = np.random.default_rng(2)
    x, book = rng.integers(-50, 50, (500, 4)), rng.integers(-50, 50, (20, 4))
    entry, distance = vector_codes.scan(x, book)
    moved = np.array([3, 7])
    new = book.copy()
    new[moved] = x[:2]
    widths = []
    full = vector_codes.distances
    monkeypatch.setattr(vector_codes, "distances", lambda a, b: widths.append((len(a), len(b))) or full(a, b))
    found = vector_codes.assign(x, new, moved, entry, distance)
    scanned = int(np.isin(entry, moved).sum())
    assert widths == [(scanned, 20), (500 - scanned, 2)]
    monkeypatch.undo()
    assert all(np.array_equal(a, b) for a, b in zip(found, vector_codes.scan(x, new)))


def test_vectors_that_cannot_be_coded_and_empty_tables(spark):
    schema = "vec_id long, embedding array<float>, label int"
    rows = [(1, [0.1, 0.2, 0.3, 0.4], 5), (2, [1.0, 2.0], 5), (3, [1e30, 0.0, 0.0, 0.0], None), (4, [], 6), (1, [0.1, 0.2, 0.3, 0.4], None)]
    codes, books = vector_codes.coded(spark.createDataFrame(rows, schema))
    found = {(r.vec_id, r.label): (r.code, r.error, r.label_error) for r in vector_codes.with_label_error(codes).collect()}
    assert books.shape == (4, 2, 1)
    assert found == {(1, 5): ("00000000", 0, 0), (2, 5): (None, None, 0), (3, None): (None, None, 0), (4, 6): (None, None, None), (1, None): ("00000000", 0, 0)}
    codes, books = vector_codes.coded(spark.createDataFrame([], schema))
    assert vector_codes.with_label_error(codes).count() == 0 and books.size == 0
    with pytest.raises(ValueError):
        vector_codes.coded(spark.createDataFrame([(1, [1.0, 2.0, 3.0], 1)], schema))


def test_new_queries_have_their_columns(spark, sf_dir):
    wanted = {
        "op11_toxicity": ["doc_id", "held_out", "score", "predicted"],
        "op12_alignment": ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"],
        "op13_vector_codes": ["vec_id", "code", "error", "label_error", "codebooks_sha256"],
    }
    for name, columns in wanted.items():
        result = queries.QUERIES[name](spark, sf_dir)
        table = "embeddings" if name == "op13_vector_codes" else "documents"
        assert set(columns) <= set(result.columns)
        assert result.count() == read(spark, sf_dir, table).count()
