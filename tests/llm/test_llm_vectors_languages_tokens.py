"""Hard negatives, language identification and token alignment against plain loops, with awkward rows."""

import hashlib
import math
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from casemill.llm import hard_negatives, language_id, token_alignment

#: Names that the operators use inside must do no harm as columns of the input.
EXTRA = "run long, tile long, radix int, `row` string, ord string, share double, found string, id string, anchor boolean, header string"
NOTHING = (None,) * len(EXTRA.split(","))


# Hard negatives


def vector_rows():
    rnd = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rnd.normal(size=6)], int(rnd.integers(0, 3))) for i in range(200)]
    rows += [(300, [1.0, 0.5], 1), (301, [], 1), (350, [], 2), (None, [1.0] * 6, 0), (7, None, 1), (8, [1.0] * 6, None)]
    rows += [(9, [1.0, None, 0.0, 0.0, 0.0, 0.0], 0), (10, [math.nan] + [0.0] * 5, 0), (11, [math.inf] + [0.0] * 5, 0)]
    rows += [rows[50], rows[50], rows[3], (50, [0.25] * 6, 2), (400, [3e4] * 6, 1), (403, [-3e4] * 6, 1)]
    return rows


def negatives_by_loop(rows):
    known = []
    for i, v, label in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        known.append((i, [math.floor(256 * x) for x in v], (label + 1) % 10 if i is not None and i % 7 == 0 else label))
    out = []
    for a, (anchor, v, label) in enumerate(known):
        if anchor is None or anchor % 50:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w)), i is None, i or 0, n, i, own) for n, (i, w, own) in enumerate(known) if n != a]
        scored.sort()
        for p in [s for s in scored if s[5] == label][:5]:
            fits = [s for s in scored if s[5] != label and 50 * -p[0] <= 100 * -s[0] <= 95 * -p[0]][:3]
            out += [(anchor, p[4], k + 1, s[4], -p[0], -s[0]) for k, s in enumerate(fits)]
    return out


def as_key(row):
    return tuple((x is None, x or 0) for x in row)


@pytest.mark.parametrize("tile,run", [(512, 16), (16, 2)])
def test_negatives_equal_a_plain_loop(spark, monkeypatch, tile, run):
    monkeypatch.setattr(hard_negatives, "TILE", tile)
    monkeypatch.setattr(hard_negatives, "RUN", run)
    rows = vector_rows()
    frame = spark.createDataFrame([r + NOTHING for r in rows], f"vec_id long, embedding array<double>, label int, {EXTRA}").repartition(3)
    got = [tuple(r) for r in hard_negatives.hard_negatives(frame).collect()]
    assert sorted(map(as_key, got)) == sorted(map(as_key, negatives_by_loop(rows)))


def test_negatives_without_anchors_or_rows(spark):
    schema = "vec_id long, embedding array<float>, label int"
    for rows in ([], [(1, [1.0], 0), (2, [0.7], 1)], [(50, [1.0], 0)], [(None, [1.0], 0), (None, None, None)]):
        assert hard_negatives.hard_negatives(spark.createDataFrame(rows, schema)).collect() == []


def test_product_is_exact_and_wraps():
    rnd = np.random.default_rng(1)
    for m, k, n in ((1, 1, 1), (33, 65, 47), (130, 70, 129), (64, 0, 64)):
        a, b = rnd.integers(-(2**40), 2**40, (m, k)), rnd.integers(-(2**40), 2**40, (k, n))
        assert (hard_negatives.product(a, b) == a @ b).all()


def test_heaps_merge_in_any_order():
    rnd = np.random.default_rng(2)
    entries = [(int(rnd.integers(0, 4)), int(rnd.integers(0, 5)), int(rnd.integers(0, 50)), bool(rnd.integers(0, 2))) for _ in range(300)]
    want = {s: sorted((-e[1], e[3], e[2]) for e in entries if e[0] == s)[:3] for s in range(4)}
    for step in (1, 7, 300):
        heaps = hard_negatives.Heaps(4, 3)
        for at in range(0, 300, step):
            slot, score, id_, unknown = map(np.array, zip(*entries[at : at + step]))
            heaps.push(slot, score, id_, unknown)
        got = zip(heaps.slot.tolist(), heaps.score.tolist(), heaps.unknown.tolist(), heaps.id.tolist())
        assert [(s, (-x, u, i)) for s, x, u, i in got] == [(s, e) for s in want for e in want[s]]


# Language identification

WORDS = {
    "en": "the house and with water that there which through would",
    "fr": "une maison avec de l’eau où les être où c’était déjà",
    "de": "das Haus und über für schön nicht durch wäre größer",
}


def language_rows():
    rnd = np.random.default_rng(3)
    rows = []
    for k in range(360):
        lang = list(WORDS)[k % 3]
        text = " ".join(rnd.choice(WORDS[lang].split(), int(rnd.integers(4, 30))))
        rows.append((k, text, lang))
    odd = [(1000, None, "en"), (1001, "", "fr"), (1002, " 123 ... \n", "de"), (1003, "the house and the water " * 9000, "en"), (None, "das Haus", None)]
    return rows + odd + [rows[0], rows[0], (1004, "Ω≈ç√", None)]


def test_languages(spark):
    rows = language_rows()
    frame = spark.createDataFrame([r + NOTHING for r in rows], f"doc_id long, text string, lang string, {EXTRA}").repartition(4)
    got = language_id.identified(frame).collect()
    assert len(got) == len(rows)
    true = {i: lang for i, _, lang in rows}
    held = [r for r in got if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 1000]
    assert len(held) > 60 and sum(r["lang_pred"] == true[r["doc_id"]] for r in held) / len(held) > 0.97
    by_id = {r["doc_id"]: r for r in got}
    assert [(by_id[i]["lang_pred"], by_id[i]["score"]) for i in (1000, 1001, 1002)] == [("und", 0.0)] * 3
    assert by_id[1003]["lang_pred"] == "en" and by_id[None]["lang_pred"] == "de"
    assert all(0 <= r["score"] <= 1 for r in got)
    assert len({r["score"] for r in got if r["doc_id"] == 0}) == 1


def test_languages_without_rows_or_labels(spark):
    schema = "doc_id long, text string, lang string"
    assert language_id.identified(spark.createDataFrame([], schema)).collect() == []
    rows = language_id.identified(spark.createDataFrame([(1, "the house", None)], schema)).collect()
    assert [(r["lang_pred"], r["score"]) for r in rows] == [("und", 0.0)]
    rows = language_id.identified(spark.createDataFrame([(i, "the house", "en") for i in range(9)], schema)).collect()
    assert {(r["lang_pred"], r["score"]) for r in rows} == {("en", 1.0)}


def grams_by_loop(text):
    letters = "".join(c if c.isalpha() else " " for c in text.lower())
    padded = f" {' '.join(letters.split())} "
    return Counter(padded[i : i + n] for n in range(1, 5) for i in range(len(padded) - n + 1) if padded[i : i + n] != " ")


@pytest.mark.parametrize("piece", [3, 7, 1 << 20])
def test_grams_equal_a_plain_loop(monkeypatch, piece):
    grams = language_id.Grams()
    monkeypatch.setattr(language_id, "PIECE", piece)
    for text in ("Hello,  wörld 12 x", "a", "a b", "ab  c", "éa" * 40, "x" * 30, "... a", "a ..."):
        here = Counter(np.concatenate(list(grams.of(text))).tolist())
        assert sorted(here.values()) == sorted(grams_by_loop(text).values())
    assert list(grams.of(None)) == [] and list(grams.of(" 12 \n" * 5)) == []


def test_weights_equal_a_plain_loop():
    rnd = np.random.default_rng(4)
    rows = [(int(rnd.integers(0, 3)), np.sort(rnd.choice(9, 4, replace=False)), rnd.random(4) * 3) for _ in range(60)]
    z, n = [[0.0] * 3 for _ in range(10)], [[0.0] * 3 for _ in range(10)]

    def weight(i, k):
        l1 = 0.0 if i == 9 else language_id.L1
        if abs(z[i][k]) <= l1:
            return 0.0
        return -(z[i][k] - math.copysign(l1, z[i][k])) / ((language_id.BETA + math.sqrt(n[i][k])) / language_id.ALPHA + language_id.L2)

    for _ in range(language_id.EPOCHS):
        for y, at, x in rows:
            feats = [*zip(at.tolist(), x.tolist()), (9, 1.0)]
            w = {(i, k): weight(i, k) for i, _ in feats for k in range(3)}
            logits = [sum(v * w[i, k] for i, v in feats) for k in range(3)]
            e = [math.exp(v - max(logits)) for v in logits]
            for i, v in feats:
                for k in range(3):
                    g = v * (e[k] / sum(e) - (k == y))
                    z[i][k] += g - (math.sqrt(n[i][k] + g * g) - math.sqrt(n[i][k])) / language_id.ALPHA * w[i, k]
                    n[i][k] += g * g
    weights, constants = language_id.fit(rows, 3, 9)
    want = np.array([[weight(i, k) for k in range(3)] for i in range(10)])
    assert np.allclose(weights, want[:9]) and np.allclose(constants, want[9])


def test_temperature_is_the_best_of_a_grid():
    rnd = np.random.default_rng(6)
    classes = rnd.integers(0, 3, 400)
    logits = rnd.normal(size=(400, 3)) * 4
    logits[np.arange(400), classes] += 3

    def loss(t):
        s = logits / t
        return -(s[np.arange(400), classes] - np.log(np.exp(s).sum(axis=1))).mean()

    best = language_id.temperature(logits, classes)
    assert loss(best) <= min(loss(t) for t in np.exp(np.linspace(-3, 3, 200))) + 1e-6
    assert language_id.temperature(np.zeros((0, 3)), np.zeros(0, int)) == 1.0


# Token alignment

PATHS = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]


def token_texts():
    rnd = np.random.default_rng(8)
    words = "the of alignment Über naïve 12,345 foo_bar 日本語 🎉 ... déjà-vu".split()
    texts = [" ".join(rnd.choice(words, int(rnd.integers(1, 40)))) for _ in range(60)]
    odd = [None, "", " ", "▁x a", "<s> <|endoftext|> </s>", "a" * 5000, "日本語" * 300 + "🎉" * 200, "a\x00b\n\n  c   d\t", "=-" * 3000, "ﬁ é é" + " " * 3000]
    return texts + odd + texts[:2]


def alignment_by_loop(texts):
    """With the tokenizers library on one side, so that the fast encoder is compared with it."""
    import sentencepiece
    from tokenizers import Tokenizer

    a_side = Tokenizer.from_file(PATHS[0])
    a_side.encode_special_tokens = True
    b_side = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    letters = token_alignment.byte_letters()
    rows, held, documents = [], [], Counter()
    for text in texts:
        links, groups, a, b = Counter(), [], [], []
        if text:
            a = a_side.encode(f" {text}", add_special_tokens=False).ids
            b = b_side.encode(text)
            a_bytes = [bytes(letters[c] for c in a_side.id_to_token(i)) for i in a]
            b_bytes = [bytes([int(b_side.id_to_piece(i)[3:5], 16)]) if b_side.is_byte(i) else b_side.id_to_piece(i).replace("▁", " ").encode() for i in b]
            if not b"".join(a_bytes) == b"".join(b_bytes) == f" {text}".encode():
                a, b, a_bytes, b_bytes = [], [], [], []
            a_ends, b_ends = (np.cumsum([len(x) for x in side]).tolist() for side in (a_bytes, b_bytes))
            i = j = 0
            for cut in sorted(set(a_ends) & set(b_ends)):
                k, m = a_ends.index(cut) + 1, b_ends.index(cut) + 1
                groups.append((a[i:k], b[j:m]))
                links.update((x, y) for x in a[i:k] for y in b[j:m])
                i, j = k, m
        joined = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        rows.append((len(a), len(b), len(groups), sum(links.values()), hashlib.sha256(joined.encode()).hexdigest() if groups else ""))
        held.append(links)
        documents.update(set(links))
    top = Counter()
    for (x, _), n in documents.items():
        top[x] = max(top[x], n)
    return [
        (*row, sum(n for (x, y), n in links.items() if documents[x, y] == top[x]), sum(n * documents[p] for p, n in links.items()))
        for row, links in zip(rows, held)
    ]


@pytest.mark.parametrize("spill,fan", [(2_000_000, 128), (700, 3)])
def test_alignment_equals_a_plain_loop(spark, monkeypatch, spill, fan):
    monkeypatch.setattr(token_alignment, "SPILL", spill)
    monkeypatch.setattr(token_alignment, "FAN", fan)
    texts = token_texts()
    frame = spark.createDataFrame([(i, t) + NOTHING for i, t in enumerate(texts)], f"doc_id long, text string, {EXTRA}").repartition(3)
    got = {r["doc_id"]: tuple(r)[1:] for r in token_alignment.aligned(frame, *PATHS, public_tokenizers.PATTERN).collect()}
    assert [got[i] for i in range(len(texts))] == alignment_by_loop(texts)


def test_alignment_without_tokens(spark):
    schema = "doc_id long, text string"
    assert token_alignment.aligned(spark.createDataFrame([], schema), *PATHS, public_tokenizers.PATTERN).collect() == []
    rows = [(None, None), (1, "")]
    got = token_alignment.aligned(spark.createDataFrame(rows, schema), *PATHS, public_tokenizers.PATTERN).collect()
    assert [tuple(r)[1:] for r in got] == [(0, 0, 0, 0, "", 0, 0)] * 2


def test_wide_groups_are_reduced_exactly(monkeypatch):
    with open(PATHS[0], encoding="utf-8") as a, open(PATHS[1], "rb") as b:
        aligner = token_alignment.Aligner(a.read(), b.read(), public_tokenizers.PATTERN)
    texts = [t for t in token_texts() if t]
    full = aligner.align(texts)
    monkeypatch.setattr(token_alignment, "WIDE", 0)
    reduced = aligner.align(texts)
    assert full[0] == reduced[0] and all((x == y).all() for x, y in zip(full[1:], reduced[1:]))
