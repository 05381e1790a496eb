"""The five pipeline stages, and the quality scores, against plain Python versions."""

import bisect
import hashlib
import math
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import tokenizers
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from panora.llm import mixing, pii, quality
from panora.llm.common import landed
from tests.llm.helpers import BYTES, ODD_TEXTS, folder, prose
from tests.llm.test_text_operators import base_spans, fingerprint, groups

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, note string"


def corpus(n):
    """Good and bad texts, exact and near copies, personal data, several leaves, awkward texts."""
    rng = random.Random(17)
    rows, labels = [], []
    for i in range(n):
        good = rng.random() < 0.75
        text = prose(rng, rng.randint(20, 150)).capitalize() + "."
        if not good:
            text = re.sub(" ", lambda m: rng.choice(["$$$ ", "*** ", " | "]), text)
        if i % 9 == 0:
            text += rng.choice([f" mail me{i}@mail.example.com now.", " at 10.0.0.7 or x@y.org z.", " 4111 1111 1111 1111 is mine."])
        rows.append((i, text, rng.choice(["en", "en", "en", "de", "fr", None]), f"src{rng.choice([0, 0, 0, 3, 7, 12, 19])}",
                     len(text), "a"))
        labels.append((i, int(good)))
    copies = [(5000 + r[0], *r[1:]) for r in rows[:40]]
    near = []
    for r in rows[40:60]:
        words = r[1].split(" ")
        words[rng.randrange(len(words))] = "changed"
        near.append((6000 + r[0], " ".join(words), *r[2:4], len(" ".join(words)), "b"))
    odd = [(7000 + i, t, "en", "src3", None if t is None else len(t), None) for i, t in enumerate(ODD_TEXTS)]
    labels += [(3, 0), (3, 0), (4, None), (None, 1)]          # several labels of one document, unusable ones
    return rows + copies + near + odd + rows[10:14], labels


# ---- plain versions -----------------------------------------------------------------------
def plain_features(text):
    raw = (text or "").encode()
    if not raw:
        return [0.0] * 24
    n, words, lines = len(raw), raw.split(), [x for x in raw.split(b"\n") if x]
    w, m = max(1, len(words)), max(1, len(lines))
    share = lambda chars: sum(c in chars for c in raw) / n
    lower, upper, digits = (set(range(ord(a), ord(b) + 1)) for a, b in ("az", "AZ", "09"))
    space, stops, loud, bar = set(b" \t\r\n\x0b\x0c"), set(b".,;:'\"()?-"), set(b"!"), set(b"|")
    symbols, high = set(b"*$%#&@^~_=+<>{}[]\\/"), set(range(128, 256))
    sizes = [len(x) for x in words]
    return [math.log1p(n), math.log1p(len(words)), sum(sizes) / w, min(200, max(sizes, default=0)),
            share(lower), share(upper), share(digits), share(space), share(stops), share(loud), share(symbols), share(bar),
            share(set(range(256)) - lower - upper - digits - space - stops - loud - bar - symbols - high), share(high),
            sum(x[-1:] in (b"*", b"$", b"%", b"#", b"&", b"@", b"!", b"|", b"~", b"^", b"=") for x in words) / w,
            sum(x.istitle() for x in words) / w, len(set(words)) / w, math.log1p(len(lines)), n / m, len(set(lines)) / m,
            1 - sum(map(len, set(lines))) / max(1, sum(map(len, lines))),
            sum(x.rstrip()[-1:] not in (b".", b"!", b"?", b":", b'"') for x in lines) / m,
            max((words.count(x) for x in set(words)), default=0) / w, sum(x < 4 for x in sizes) / w]


def plain_model(rows, labels):
    """Learnt from the labelled rows that are not held out, in the order of their ids' hashes."""
    ones, n = Counter(), Counter()
    for i, y in labels:
        if i is not None and y is not None and zlib.crc32(str(i).encode()) % 5:
            ones[i] += y
            n[i] += 1
    seed = lambda i: struct.unpack("<q", xxhash.xxh64(struct.pack("<q", i), seed=42).digest()[::-1])[0]
    known = sorted(((seed(r[0]), r[0], np.float32(plain_features(r[1])).tobytes()) for r in rows if n[r[0]]))
    x = np.array([np.frombuffer(f, np.float32) for _, _, f in known]).astype(float)
    return quality.train(x, np.array([float(2 * ones[i] >= n[i]) for _, i, _ in known]))


def plain_score(model, text):
    x = [float(v) for v in np.float32(plain_features(text))]
    z = model.base + sum(t[bisect.bisect_right(list(c), v)] for c, t, v in zip(model.cuts, model.tables, x))
    for (f, a, g, b), t in zip(model.pair_cuts, model.pair_tables):
        z += t[bisect.bisect_right(list(a), x[f])][bisect.bisect_right(list(b), x[g])]
    return 1 / (1 + math.exp(-z))


def plain_dedup(rows):
    """Of each group the row with the smallest doc_id (ids name one text each)."""
    best = {}
    for r, g in zip(rows, groups([fingerprint(r[1]) for r in rows], 2)):
        best[g] = min(best.get(g, r), r, key=lambda x: x[0])
    return list(best.values())


def added_spans(docs):
    """Spans that the trained model adds to the base ones (its scores have a test of their own), by doc_id."""
    found = pii.candidates(docs)
    spans = pii.detect(found, pii.fit(found)).select("doc_id", F.expr("inline(__pii_spans)")).collect()
    return [(r.doc_id, r.start, r.kind, r.end) for r in spans if r.kind > 3]


def plain_redact(rows, added):
    out = []
    for i, text, *rest, chars, note in rows:
        merged = []
        for a, kind, b in sorted(base_spans(text) + [s[1:] for s in added if s[0] == i]):
            if merged and a < merged[-1][2]:
                merged[-1][2] = max(merged[-1][2], b)
            else:
                merged.append([a, kind, b])
        new, at = "", 0
        for a, kind, b in merged:
            new += text[at:a] + f"[{pii.KINDS[kind].upper()}]"
            at = b
        new = new + text[at:] if merged else text
        out.append((i, new, *rest, len(new) if merged else chars, note))
    return out


def plain_split(budget, children):
    """Budget over (name, weight, capacity): children that can be filled get what they can give, smallest first."""
    order, out = sorted(children, key=lambda c: (c[2] / c[1], c[0])), {}
    left, weights = budget, sum(c[1] for c in children)
    while order and order[0][2] * weights <= order[0][1] * left:
        name, w, cap = order.pop(0)
        out[name], left, weights = cap, left - cap, weights - w
    given = {name: w * left // weights for name, w, _ in order}
    more = left - sum(given.values())
    return {**out, **{name: given[name] + (k < more) for k, (name, _, _) in enumerate(order)}}


def plain_mix(rows):
    leaves, spans = defaultdict(list), re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+")
    for r in rows:
        source = r[3] or ""
        number = re.search("[0-9]{1,6}$", source)
        place = int(number[0]) // 5 if number else 0
        domain = mixing.DOMAINS[place] if place < len(mixing.DOMAINS) else "web"
        leaves[domain, r[2] or "", source].append((r, len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))))
    total = {leaf: sum(t for _, t in found) for leaf, found in leaves.items()}
    budgets = {(): sum(total.values())}
    for depth, level in enumerate(["domain", "lang", "source"]):
        for parent in {leaf[:depth] for leaf in leaves}:
            caps = Counter()
            for leaf, n in total.items():
                if leaf[:depth] == parent:
                    caps[leaf[depth]] += 2 * n
            shares = plain_split(budgets[parent], [(c, mixing.WEIGHTS[level].get(c, 1), cap) for c, cap in caps.items()])
            budgets.update({(*parent, c): b for c, b in shares.items()})
    out = []
    for leaf, found in leaves.items():
        if not total[leaf]:
            continue
        epochs, rest = divmod(budgets[leaf], total[leaf])
        md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
        order = sorted(((md5(f"7:{epochs}:{r[0]}:{md5(r[1] or '')}"), r[0], r, t) for r, t in found if t), key=lambda x: x[:2])
        for _, _, r, t in order:
            out += [r] * epochs
            if rest >= t:
                out.append(r)
            elif rest > 0:
                text = "".join(spans.findall(r[1])[:rest])
                out.append((r[0], text, *r[2:4], len(text), r[5]))
            rest = max(0, rest - t)
    return out


# ---- tests -----------------------------------------------------------------------------------
def test_features_and_scores_equal_plain_versions(spark):
    rows, labels = corpus(500)
    texts = [r[1] for r in rows] + ["the the the the cat", "a\n\na\nb", "é É ñ"]
    np.testing.assert_allclose(quality.features(texts), [plain_features(t) for t in texts], rtol=1e-12)
    model = plain_model(rows, labels)
    assert model.pair_cuts
    docs = spark.createDataFrame(rows, SCHEMA)
    got = quality.score(docs, quality.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int"))).collect()
    want = sorted((r[0], plain_score(model, r[1])) for r in rows)
    assert [i for i, _ in want] == sorted(r.doc_id for r in got)
    np.testing.assert_allclose([s for _, s in sorted(map(tuple, got))], [s for _, s in want], rtol=1e-9)


def test_most_frequent_word():
    at = quality.FEATURES.index("top_word")
    # the most frequent word, wherever the others stand
    assert [quality.features([t])[0][at] for t in ("a a a b c", "b a c a a", "b c d", " ", None)] == [0.6, 0.6, 1 / 3, 0, 0]


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    rows, labels = corpus(600)
    at = folder(tmp_path_factory.mktemp("corpus"), documents=spark.createDataFrame(rows, SCHEMA),
                labels=spark.createDataFrame(labels, "doc_id long, quality int"))
    return rows, labels, at


def test_every_stage_equals_its_plain_version(spark, made):
    rows, labels, at = made
    docs = spark.read.parquet(f"{at}/documents.parquet")
    model = plain_model(rows, labels)
    scores = [plain_score(model, r[1]) for r in rows]
    assert all(abs(s - quality.THRESHOLD) > 1e-9 for s in scores)
    plain, kept = [r for r, s in zip(rows, scores) if s >= quality.THRESHOLD], [len(rows)]
    steps = [None, plain_dedup, lambda x: plain_redact(x, added_spans(docs)), plain_mix]
    for (name, stage), step in zip(corpus_pipeline.STAGES, steps):
        plain = step(plain) if step else plain
        docs = landed(stage(spark, docs, at), "plain-stage")
        assert Counter(map(tuple, docs.collect())) == Counter(plain), name
        kept.append(len(plain))
    assert kept[0] > kept[1] > kept[2] == kept[3] != kept[4]
    assert any("[EMAIL]" in (r[1] or "") for r in plain) and any("[CARD]" in (r[1] or "") for r in plain)
    assert max(Counter(r[0] for r in plain).values()) == 2       # a leaf that is taken more than once
    # packing: every id of every mixed row lies in one piece, sequences are gapless
    encode = tokenizers.Tokenizer.from_file(BYTES).encode
    ids = defaultdict(lambda: (Counter(), []))
    for r in plain:
        own = tuple([*encode(r[1] or "", add_special_tokens=False).ids, 1])
        ids[r[0], len(own)][0][own] += 1
    pieces, sequences = defaultdict(list), defaultdict(list)
    for p in corpus_pipeline.run(spark, at).collect():
        pieces[p.doc_id, p.doc_tokens].append((p.start, p.length, p.ids_crc32))
        sequences[p.sequence_id].append((p.offset, p.length))
    assert set(pieces) == set(ids)
    for key, found in pieces.items():
        texts = ids[key][0]
        covered = np.zeros(key[1], int)
        for start, length, crc in found:
            assert crc in {zlib.crc32(np.array(t[start:start + length], "<u4").tobytes()) for t in texts}
            covered[start:start + length] += 1
        assert (covered == sum(texts.values())).all()
    for found in sequences.values():
        ends = 0
        for offset, length in sorted(found):
            assert offset == ends
            ends += length
        assert ends <= 2048


def test_stages_of_no_documents(spark, made):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, made[2])
        assert docs.columns == [c.split()[0] for c in SCHEMA.split(", ")] and docs.filter(F.lit(True)).count() == 0
