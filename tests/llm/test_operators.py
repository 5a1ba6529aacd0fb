"""The corpus operators against plain versions of themselves, on small fixtures with every odd row."""

import base64
import hashlib
import math
import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

from weftline.llm import bpe, chat, components, embed_dedup, html_extract, langid, mixing, pii, quality, simhash, toxicity

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, size int, fp string"
WORDS = "the cat sat on a mat and saw nine small red birds over some old grey house near this river".split()


def words(n, seed=0):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    """Null and empty texts, a long one, copies, near copies, repeated rows, null keys, clashing extra columns."""
    base = words(300, 1)
    near = base.replace("river", "lake", 1)
    texts = [
        None, "", " \t\n", base, base, near, words(40, 2), words(20000, 3), "it's 'tis  a b c\x1cd \U0001f600\n\n x!!",
        "één über ÀÉ naïve 東京 123 ½"
    ]
    rows = [(i, t, "en", f"s{i % 3}" if i % 4 else None, None, 1, "x") for i, t in enumerate(texts)]
    rows += [rows[3], (None, "no id", None, None, None, 1, "x"), (None, None, None, None, None, 1, "x")]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def roots(nodes, edges):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(4)
    edges = [
        (rng.randrange(300), rng.randrange(300)) for _ in range(220)
    ] + [(i, i + 1) for i in range(400, 460)] + [(5, 5), (None, 3)]
    got = {
        r["node"]: r["root"] for r in components.connected_components(
            spark.createDataFrame(edges, "u bigint, v bigint")
        ).collect()
    }
    real = [(a, b) for a, b in edges if a is not None and a != b]
    assert got == roots({x for e in real for x in e}, real)


def plain_fingerprint(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not found:
        return 0
    shingles = [" ".join(found[i : i + 3]) for i in range(max(1, len(found) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(docs, no_docs):
    got = simhash.near_duplicates(docs).collect()
    rows = docs.collect()
    assert Counter((r["doc_id"], r["fingerprint"]) for r in got) == Counter(
        (r["doc_id"], f"{plain_fingerprint(r['text']):016x}") for r in rows
    )
    prints = [plain_fingerprint(r["text"]) for r in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3]
    root = roots(range(len(rows)), pairs)
    least = defaultdict(list)
    for i, r in enumerate(rows):
        least[root[i]].append(r["doc_id"])
    expected = Counter(
        (r["doc_id"], min((x for x in least[root[i]] if x is not None), default=None)) for i, r in enumerate(rows)
    )
    assert Counter((r["doc_id"], r["component_id"]) for r in got) == expected
    assert simhash.near_duplicates(no_docs).count() == 0


@pytest.mark.parametrize("max_bits", [3, 2])
def test_simhash_index_loses_no_link(spark, max_bits):
    rng = random.Random(8)
    values = set()
    for _ in range(150):
        centre = rng.getrandbits(64)
        values |= {centre} | {
            centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(1, 5))) for _ in range(6)
        }
    dense = rng.getrandbits(64)
    values |= {dense ^ sum(1 << b for b in rng.sample(range(64), 2)) for _ in range(120)}
    values = sorted(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    found = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp bigint"), max_bits).collect()
    unsigned = [(r["u"] % (1 << 64), r["v"] % (1 << 64)) for r in found]
    assert all((a ^ b).bit_count() <= max_bits for a, b in unsigned)
    true = [(a, b) for i, a in enumerate(values) for b in values[:i] if (a ^ b).bit_count() <= max_bits]
    assert roots(values, unsigned) == roots(values, true)


def test_byte_bpe(docs, no_docs, spark):
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    engine = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = docs.select("doc_id", "text").collect()
    expected = Counter()
    for r in rows:
        ids = engine.encode_ordinary(r["text"] or "")
        expected[
            r["doc_id"], len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256((r["text"] or "").encode()).hexdigest()
        ] += 1
    for settings in ({}, {"block_words": 30, "shards": 3}, {"block_size": 50}):
        got = bpe.encode(docs, ranks, public_tokenizers.PATTERN, output="digest", **settings)
        assert Counter(map(tuple, got.collect())) == expected
    ids = bpe.encode(docs, ranks, public_tokenizers.PATTERN)
    assert Counter(
        (r["doc_id"], bytes(r["bytes"]).decode()) for r in bpe.decode(ids, ranks).collect()
    ) == Counter((r["doc_id"], r["text"] or "") for r in rows)
    assert bpe.encode(no_docs, ranks, public_tokenizers.PATTERN).count() == 0
    assert bpe.decode(
        spark.createDataFrame([(1, None)], "doc_id bigint, ids array<int>"), ranks
    ).first()["bytes"] == b""


def test_byte_bpe_splits_like_the_library():
    ranks = {
        base64.b64decode(a): int(b) for a,
        b in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))
    }
    engine = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(3)
    alphabet = "ab'sté1½ \t\n  \x1c\x85!?<|>東\U0001f600"
    latin = "".join(map(chr, range(256)))
    for i in range(1500):
        text = "".join(rng.choice(latin if i % 3 == 0 else alphabet) for _ in range(rng.randrange(30)))
        assert [
            i for w in bpe.splitter(public_tokenizers.PATTERN)(text) for i in engine.encode_ordinary(w)
        ] == engine.encode_ordinary(text)


def test_mixing(docs, no_docs, spark):
    got = mixing.with_copies(docs).collect()
    rows = [(r["doc_id"], r["source"], len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))) for r in docs.collect()]
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((i, n) for i, _, n in rows)
    totals = Counter()
    for _, s, n in rows:
        totals[s] += n
    order = sorted(totals, key=lambda s: (s is None, s))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    target, open_, rest = {}, set(order), float(sum(totals.values()))
    while True:
        share = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 3 * totals[s]}
        if not over:
            target |= share
            break
        for s in over:
            target[s] = 3.0 * totals[s]
            rest -= target[s]
        open_ -= over
    by_size = {round(v, 6) for v in target.values()}
    assert {round(r["target"], 6) for r in got} == by_size
    assert all(r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 3 for r in got)
    assert sorted(map(tuple, got), key=str) == sorted(
        map(tuple, mixing.with_copies(docs.repartition(3)).collect()), key=str
    )
    assert mixing.with_copies(no_docs).count() == 0
    assert mixing.mixed(docs).columns == docs.columns
    assert mixing.mixed(docs).count() == sum(r["copies"] for r in got)


def test_mixing_meets_targets(spark):
    rng = random.Random(5)
    rows = [
        (
            i, "a b c d e f g h i j "[: 2 * rng.randrange(1, 10)] * rng.randrange(1, 30), f"s{min(rng.randrange(9), 6)}"
        ) for i in range(1500)
    ] + [(9000 + i, "x " * 40, "s6") for i in range(600)]
    taken, target = Counter(), {}
    biggest = 0
    for r in mixing.with_copies(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).collect():
        taken[r["source_size"]] += r["taken"]
        target[r["source_size"]] = r["target"]
        biggest = max(biggest, r["size"])
    assert len(target) == 7
    assert all(abs(taken[s] - t) <= 3 * biggest for s, t in target.items())


def test_mixing_tilt_solves_the_dual(spark):
    cells = spark.createDataFrame(
        [("a", s, n) for s, n in ((1, 50), (10, 20), (100, 9), (1000, 2))] + [("b", 5, 7), ("b", 50, 7)],
        "key string, size bigint, n bigint"
    )
    sized = cells.withColumn("i", F.explode(F.sequence(F.lit(1), F.col("n").cast("int")))).select("key", "size")
    goals = mixing.targets(sized)
    by_key = defaultdict(list)
    for r in cells.collect():
        by_key[r["key"]].append((r["size"], r["n"]))
    for r in mixing.tilts(cells, goals).collect():
        words_taken = sum(
            n * s * (3.0 if r["tilt"] is None else min(3.0, math.exp(r["tilt"] * s / r["mean"]))) for s,
            n in by_key[r["key"]]
        )
        assert words_taken == pytest.approx(r["target"], rel=1e-6)


def test_embeddings(spark):
    rng = np.random.default_rng(2)
    rows = []
    centres = rng.normal(size=(6, 16))
    for i in range(500):
        v = centres[i % 6] + rng.normal(size=16) * (0.05 if i % 6 < 2 else 0.25) if i < 300 else rng.normal(size=16)
        rows.append((i, [float(np.float32(x)) for x in v], i % 2 if i % 50 else None))
    odd = [
        (1000, None, 1), (1001, [0.0] * 16, 1), (1002, [float("nan")] * 16, 1), (1003, [float("inf")] + [1.0] * 15, 1),
        (1004, [None] + [1.0] * 15, 1), (None, [1.0] * 16, 1), (1005, [1.0] * 3, 1), (1006, [2.0] * 3, 1), (1007, [], 1)
    ]
    frame = spark.createDataFrame(rows + odd + [rows[1]], "vec_id bigint, embedding array<float>, label int")
    got = embed_dedup.near_duplicates(frame).collect()
    assert len(got) == len(rows) + len(odd) + 1
    rows.append(rows[1])  # a repeated row is one more vector
    ids = [i for i, _, label in rows if label is not None]
    x = np.array([v for _, v, label in rows if label is not None])
    x /= np.linalg.norm(x, axis=1)[:, None]
    label = np.array([label for *_, label in rows if label is not None])
    linked = (x @ x.T >= 0.93) & (label[:, None] == label[None, :])
    np.fill_diagonal(linked, False)
    degree = dict(zip(ids, linked.sum(1).tolist())) | {1005: 1, 1006: 1}
    found = {r["vec_id"]: r for r in got}
    assert all(found[i]["n_links"] <= degree.get(i, 0) for i in found)
    assert sum(found[i]["n_links"] for i in degree) >= 0.97 * sum(degree.values())
    true = roots(range(len(ids)), zip(*np.nonzero(linked)))
    same = sum(found[i]["component_id"] == ids[true[k]] for k, i in enumerate(ids))
    assert same >= 0.97 * len(ids)
    assert all(r["kept"] == (r["vec_id"] is None or r["vec_id"] == r["component_id"]) for r in got)
    assert embed_dedup.near_duplicates(frame.limit(0)).count() == 0


def test_embeddings_under_one_id(spark):
    """Different vectors that share a vec_id are all compared; a component of null ids alone has none."""
    rows = [
        (1, [1.0, 0.0], 1), (1, [0.0, 1.0], 1), (2, [0.0, 2.0], 1), (3, [3.0, 0.0], 1), (None, [-1.0, 0.0], 1),
        (None, [-2.0, 0.0], 1)
    ]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    got = sorted(
        (
            r["vec_id"] or 0, r["n_links"], r["component_id"] or 0, r["kept"]
        ) for r in embed_dedup.near_duplicates(frame).collect()
    )
    assert got == [
        (0, 1, 0, True), (0, 1, 0, True), (1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 1, 1, False)
    ]


def test_embeddings_do_not_depend_on_partitions(spark):
    """Cuts between partitions part no pair, whatever their number."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(1500, 16))
    x /= np.linalg.norm(x, axis=1)[:, None]
    rows = np.concatenate([x, partner(rng, x[:500], 0.94), np.repeat(x[:20], 4, axis=0)])
    units = spark.createDataFrame(
        [(i, "1", v.tolist(), 4) for i, v in enumerate(rows)],
        "node bigint, label string, unit array<double>, passes int"
    )
    found = [
        {tuple(r) for r in embed_dedup.candidate_links(units, 0.93, 8, 64, 5, size).collect()}
        for size in (1 << 30, 2080 * 16 * 8 * 4 // 4, 2080 * 16 * 8 * 4 // 32, 2080 * 16 * 8 * 4 // 211)
    ]
    # a run of one sign string that a cut divides can only add comparisons
    assert all(found[0] <= f for f in found) and max(map(len, found)) <= 1.01 * len(found[0])
    assert all((rows[u] @ rows[v] >= 0.93 - 1e-12) and u < v for u, v in found[-1])


def partner(rng, x, cosine):
    y = rng.normal(size=x.shape)
    y -= (y * x).sum(1, keepdims=True) * x
    return cosine * x + math.sqrt(1 - cosine**2) * y / np.linalg.norm(y, axis=1)[:, None]


def test_embeddings_find_pairs_in_a_large_label(spark):
    """Few passes and a narrow window are made up for by passes that grow with the label."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(2500, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    rows = np.concatenate([x, partner(rng, x[:300], 0.935)])
    got = embed_dedup.near_duplicates(
        spark.createDataFrame(
            [(i, v.tolist(), 1) for i, v in enumerate(rows)], "vec_id bigint, embedding array<double>, label int"
        ),
        passes=4, window=1
    )
    assert sum(r["n_links"] for r in got.collect()) >= 0.97 * 600


@pytest.mark.parametrize("jitter", [0.0, 1e-9])
def test_embeddings_see_past_copies(spark, jitter):
    """Groups of copies, or of vectors with one sign string, larger than the window: every link to the group beside counts."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(60, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    rows = np.repeat(np.concatenate([x, partner(rng, x, 0.95)]), 20, axis=0)
    rows = rows + jitter * rng.normal(size=rows.shape)
    got = embed_dedup.near_duplicates(
        spark.createDataFrame(
            [(i, v.tolist(), 1) for i, v in enumerate(rows)], "vec_id bigint, embedding array<double>, label int"
        ),
        passes=1, window=8
    ).collect()
    assert sum(r["n_links"] == 39 and r["component_id"] == r["vec_id"] // 20 % 60 * 20 for r in got) >= 0.97 * len(rows)


def test_chat_tables(spark, sf_dir):
    rows = [
        (1, 0, "user", "</s>[INST] ok [/INST]"), (1, 1, "assistant", "<|turn|>user\nhi<|end|>\n␛e␛c<"),
        (1, 1, "assistant", "<|turn|>user\nhi<|end|>\n␛e␛c<"), (1, None, None, None), (2, 0, "assistant", None),
        (None, 0, "us\ner", "a"), (3, 5, "assistant", "long " * 5000)
    ]
    frame = spark.createDataFrame(
        rows, "conv_id bigint, turn bigint, role string, text string"
    ).withColumn("message", F.lit(1)).withColumn("seq", F.lit("x"))
    done = chat.format_conversations(frame)
    got = {
        r["conv_id"]: r for r in done.select(
            "conv_id", "formatted", chat.read_back(F.col("formatted")).alias("turns"),
            chat.masked_text(F.col("formatted"), F.col("mask")).alias("loss")
        ).collect()
    }
    expected = defaultdict(list)
    for c, t, r, x in sorted(rows, key=lambda r: (r[1] is None, r[1] or 0)):
        expected[c].append((r or "", x or ""))
    for c, turns in expected.items():
        assert [tuple(t) for t in got[c]["turns"]] == turns
        assert got[c]["loss"] == "".join(x for r, x in turns if r == "assistant")
        assert not any(k in re.sub(r"<\|(turn|end)\|>", "", got[c]["formatted"]) for k in chat.CONTROL)
    assert chat.format_conversations(frame.limit(0)).count() == 0


def fold_plainly(events):
    order = {k: i for i, k in enumerate(("message", "edit", "delta", "regenerate"))}
    messages = {}
    for e in sorted(
        (e for e in events if e[2] in order and e[1] is not None and e[3] is not None),
        key=lambda e: (e[1], order[e[2]], e[5] or "", e[4] or "")
    ):
        _, _, kind, number, role, text = e
        if kind == "regenerate":
            messages = {k: v for k, v in messages.items() if k < number}
        elif kind == "message":
            messages[number] = [role or "", text or ""]
        else:
            own = messages.setdefault(number, ["", ""])
            own[1] = (text or "") if kind == "edit" else own[1] + (text or "")
    return {k: tuple(v) for k, v in messages.items()}


def test_chat_events_fold(spark):
    rng = random.Random(6)
    events = [
        (
            c, rng.randrange(40), rng.choice(["message", "delta", "delta", "edit", "regenerate", "other", None]),
            rng.choice([0, 1, 2, 3, 4, None]), rng.choice(["user", "assistant"]), rng.choice(["a", "b ", None, "<s>"])
        ) for c in range(40) for _ in range(25)
    ]
    frame = spark.createDataFrame(
        events, "conv_id bigint, seq bigint, kind string, message bigint, role string, text string"
    )
    got = defaultdict(dict)
    for r in chat.folded(frame).collect():
        got[r["conv_id"]][r["message"]] = (r["role"], r["text"])
    for c in range(40):
        assert got[c] == fold_plainly([e for e in events if e[0] == c])


def luhn(digits):
    return sum(d * 2 - 9 * (d > 4) if i % 2 else d for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def iban_ok(text):
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97 == 1


PERSONAL = [
    "ann.Lee-99@mail7.example.com", "DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432", "190.137.223.204",
    "1999-12-31", "3/4/2020", "24.12.1987", "078-05-1120", "4111 1111 1111 1111", "4111111111111111", "378282246310005",
    "+1 (826) 555-4081", "+33 1 23 45 67 89", "(017) 555-7713", "826-555-4081"
]
HARMLESS = [
    "4111111111111112", "DE88370400440532013000", "2021-02-30", "1.2.3", "300.1.2.3", "000-12-3456", "version 10.4",
    "call 555", "a@b", "9b0b3c6a43eb78aa99cbd7049c572391524f37a8", "31/02/2020"
]


def test_chat_log_folds_back(spark, sf_dir):
    """Deltas, edits and regenerations occur, and the log says what the table of turns says."""
    rows = [
        (
            c, t, random.Random(c * 9 + t).choice(["user", "assistant", "us\ner", None]),
            words(c + t, t) if t % 4 else None
        ) for c in range(8) for t in range(9)
    ]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    events = chat.streamed_events(frame)
    assert {r["kind"] for r in events.select("kind").distinct().collect()} == {"message", "delta", "edit", "regenerate"}
    plain = chat.format_conversations(frame).collect()
    assert sorted(plain) == sorted(chat.format_log(events).collect())
    assert chat.format_log(chat.streamed_events(frame.limit(0))).count() == 0


def feistel_plainly(a, b, left, right, tweak, key):
    for i in range(pii.ROUNDS):
        by, size, x = (right, a, left) if i % 2 == 0 else (left, b, right)
        digest = hashlib.sha256(f"{key}|{tweak}|{i}|{by}".encode()).hexdigest()
        moved = (x + int(digest[:15], 16) % size) % size
        left, right = (moved, right) if i % 2 == 0 else (left, moved)
    return left, right


def test_feistel_by_brute_force(spark):
    """Digit strings of any length against plain Python."""
    rng = random.Random(12)
    given = ["".join(rng.choice("0123456789") for _ in range(n)) for n in range(1, 37) for _ in range(3)]
    frame = spark.createDataFrame([(d,) for d in given], "d string")
    for r in frame.select("d", pii.permuted_digits(F.col("d"), F.lit("t"), "k").alias("p")).collect():
        d, u = r["d"], len(r["d"]) // 2
        v = len(d) - u
        left, right = feistel_plainly(10**u, 10**v, int(d[:u] or 0), int(d[u:]), f"t:{len(d)}", "k")
        assert r["p"] == (f"{left:0{u}d}" if u else "") + f"{right:0{v}d}"


def test_phone_pseudonyms_ignore_punctuation(spark):
    pairs = [
        ("+44 20 7946 0958", "+442079460958"), ("+49 (30) 901820-11", "+493090182011"),
        ("+1 (826) 555-4081", "+1.826.555.4081"), ("+352 26 12 34 56", "+35226123456")
    ]
    frame = spark.createDataFrame([(i, x) for i, p in enumerate(pairs) for x in p], "doc_id bigint, text string")
    got = defaultdict(set)
    for r in pii.pseudonymised(frame, "k").collect():
        got[r["doc_id"]].add(re.sub(r"\D", "", r["text"]))
        assert r["text"] not in pairs[r["doc_id"]]
    assert all(len(x) == 1 for x in got.values())


def test_simhash_sets_meet_all_pairs():
    """Whatever three bytes differ, one set of positions has none of them."""
    from itertools import combinations

    assert all(any(not set(s) & set(bad) for s in simhash.POSITIONS) for bad in combinations(range(8), 3))


def test_pii(spark, docs, no_docs):
    texts = [f"x {v}, y" for v in PERSONAL + HARMLESS] + [
        "+1 (826) 555-4081 190.137.223.204 ann.Lee-99@mail7.example.com.", "4111-1111-1111-1111 4111111111111111",
        "ANN.lee-99@mail7.example.com", None, "", "no data",
        "é 4111111111111111 \U0001f600 (017) 555-7713 " + words(20000)
    ]
    frame = spark.createDataFrame(
        list(enumerate(texts)), "doc_id bigint, text string"
    ).withColumn("gap", F.lit(1)).withColumn("hit", F.lit(1))
    got = {r["doc_id"]: (r["text"], r["n_values"]) for r in pii.pseudonymised(frame, "k").collect()}
    new = {v: got[i][0][2:-3] for i, v in enumerate(PERSONAL)}
    for i, v in enumerate(PERSONAL):
        assert v not in got[i][0] and got[i][1] == 1, (v, got[i])
        if "/" not in v:
            assert re.sub(
                r"\d", "9", re.sub("[a-z]", "a", re.sub("[A-Z]", "A", new[v]))
            ) == re.sub(r"\d", "9", re.sub("[a-z]", "a", re.sub("[A-Z]", "A", v))) or re.fullmatch(r"[\d.]+", v)
    for i, v in enumerate(HARMLESS, len(PERSONAL)):
        assert got[i] == (texts[i], 0), v
    n = len(PERSONAL) + len(HARMLESS)
    assert got[n] == (f"{new['+1 (826) 555-4081']} {new['190.137.223.204']} {new['ann.Lee-99@mail7.example.com']}.", 3)
    digits = lambda s: re.sub(r"\D", "", s)
    assert digits(got[n + 1][0]) == 2 * digits(new["4111 1111 1111 1111"]) == 2 * new["4111111111111111"]
    assert got[n + 2][0].lower() == new["ann.Lee-99@mail7.example.com"].lower()
    assert luhn(new["4111111111111111"]) and luhn(new["378282246310005"]) and iban_ok(
        new["GB82WEST12345698765432"]
    ) and iban_ok(
        new["DE89 3704 0044 0532 0130 00"].replace(" ", "")
    )
    assert got[n + 3] == (None, 0) and got[n + 4] == ("", 0) and got[n + 5] == ("no data", 0)
    assert got[n + 6][1] == 2 and got[n + 6][0].endswith(words(20000))
    other = {r["doc_id"]: r["text"] for r in pii.pseudonymised(frame, "other key").collect()}
    assert sum(other[i] != got[i][0] for i in range(len(PERSONAL))) == len(PERSONAL)
    assert pii.pseudonymised(docs, "k").count() == docs.count() and pii.pseudonymised(no_docs, "k").count() == 0


@pytest.mark.parametrize("a,b", [(10, 100), (189, 773), (1, 26), (100, 100)])
def test_feistel_permutes(spark, a, b):
    n = a * b
    out = pii.feistel(
        F.lit(a).cast("bigint"), F.lit(b).cast("bigint"), (F.col("id") - F.col("id") % b) / b, F.col("id") % b,
        F.lit("t"), "k"
    )
    distinct = spark.range(n).select(out.alias("s")).select(
        (F.col("s.left") * b + F.col("s.right")).alias("y")
    ).agg(F.countDistinct("y"), F.min("y"), F.max("y")).first()
    assert tuple(distinct) == (n, 0, n - 1)


def test_quality_statistics():
    given = ["a b c a b c d\nx #$ y\n\n a b\nx #$ y", "", "a b", "a b c a b c d\nx #$ y"]
    bases, features = quality.statistics(given)
    base = bases[0].tolist()
    found = re.findall(r"\S+", "a b c a b c d\nx #$ y\n\n a b\nx #$ y")
    windows = [tuple(found[i : i + 3]) for i in range(len(found) - 2)]
    covered = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 3)}
    assert base == [
        len(found), sum(map(len, found)), 4, 1, len(covered)
    ] and features.shape == (4, len(quality.FEATURES))
    assert bases[1].tolist() == [0] * 5 and bases[2].tolist() == [2, 2, 0, 0, 0] and bases[3][4] == 6
    assert quality.statistics([])[0].shape == (0, 5)


def test_quality_statistics_by_brute_force():
    rng = random.Random(5)
    texts = ["".join(rng.choice("a b c\n#\x1c\x85 Éé9.") for _ in range(rng.randrange(60))) for _ in range(300)]
    for text, base in zip(texts, quality.statistics(texts)[0].tolist()):
        found = re.findall(r"[^\x20\x09-\x0D]+", text)
        windows = [tuple(found[i : i + 3]) for i in range(len(found) - 2)]
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        covered = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 3)}
        assert base == [
            len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            len(covered)
        ]


def test_samples_are_bounded(spark):
    """However often a row is repeated and whatever its id, no more than asked for is drawn; small labels are whole."""
    from weftline.llm.common import bounded_sample

    frame = spark.range(20_000).select(F.lit(7).alias("doc_id"), F.lit("same").alias("text"), F.lit("a").alias("label"))
    more = spark.range(5000).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"),
        F.when(F.col("id") < 30, "b").otherwise("c").alias("label")
    )
    drawn = bounded_sample(frame.union(more), "label", 400, "doc_id", "text")
    assert {r["label"]: r["count"] for r in drawn.groupBy("label").count().collect()} == {"a": 400, "b": 30, "c": 400}
    assert sorted(drawn.collect()) == sorted(drawn.repartition(3).collect())
    with pytest.raises(ValueError):
        bounded_sample(more, "text", 4, "doc_id", max_labels=10)


def test_long_labelled_texts_are_scored_but_not_learned(spark):
    rows = [(i, words(30, i) + " snarfle snarfled" * (i % 2)) for i in range(60)] + [(100, "snarfle " * 2_000_000)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(100, 0)], "doc_id bigint, toxic int")
    got = {
        r["doc_id"]: r["predicted"] for r in toxicity.score_documents(frame, toxicity.train(frame, labels)).collect()
    }
    assert got[100] == 1 and sum(got[i] == i % 2 for i in range(60)) >= 54

def test_quality_forest(spark, docs, no_docs):
    rng = np.random.default_rng(1)
    x = np.r_[rng.normal(size=(500, 3)), rng.normal(size=(20, 3)) + 9]
    forest = quality.grow(x)
    score = forest.score(x)
    assert score[500:].min() > np.quantile(score[:500], 0.99) and 0 <= score.min() and score.max() <= 1

    def path(tree, row):  # one row, node by node
        node = 0
        while forest.left[tree][node] != node:
            node = forest.left[tree][node] if row[
                forest.feature[tree][node]
            ] < forest.cut[tree][node] else forest.right[tree][node]
        return forest.path[tree][node]

    plain = [
        2 ** (
            -np.mean(
                [path(t, r) for t in range(len(forest.feature))]
            ) / float(quality._average_path(np.array(forest.size)))
        ) for r in x[:20]
    ]
    assert np.allclose(plain, score[:20])
    forest.threshold = quality.calibrate(forest, x[:500], x[500:])
    assert (forest.score(x[500:]) > forest.threshold).all()
    labels = spark.createDataFrame([(3, 1), (7, 0), (None, 1), (4, None)], "doc_id bigint, quality int")
    got = quality.measured(docs, quality.train(docs, labels)).collect()
    assert len(got) == docs.count()
    assert all(
        r["base_failed"] == (
            r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]
        ) and not (r["base_failed"] and r["kept"]) for r in got
    )
    assert quality.measured(no_docs, quality.train(no_docs, labels.limit(0))).count() == 0


def test_quality_counts_all_documents(spark):
    """Leaves hold all documents, and no other threshold is better for all labelled rows, however many there are."""
    rng = random.Random(5)
    label, texts = [int(rng.random() < 0.85) for _ in range(6000)], []
    for good in label:
        odd = rng.random() * (0.2 if good else 1.0)
        texts.append(
            " ".join(
                rng.choice(("ab", "cd", "e9", "Fg.")) + rng.choice("xyz") * rng.randrange(4)
                + f"#{rng.randrange(99)}" * (rng.random() < odd) for _ in range(rng.randrange(52, 70))
            )
        )
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    forest = quality.train(docs, spark.createDataFrame(list(enumerate(label)), "doc_id bigint, quality int"))
    base, x = quality.statistics(texts)
    fit = (base[:, 0] >= 50) & (100 * base[:, 4] <= 50 * base[:, 0])
    score, good = forest.score(x)[fit], np.array(label)[fit] == 1
    assert good.sum() > 4000

    def gain(cut):
        lost = (score[good] > cut).mean()
        return (score[~good] > cut).mean() - 10 * lost if lost <= 0.01 else -np.inf

    best = max(gain(c) for c in np.arange(quality.GRID + 1) / quality.GRID if abs(c - forest.threshold) < 0.05)
    assert gain(forest.threshold) == best > 0
    counts = forest.counts(x[fit])
    assert (counts.sum(1) == fit.sum()).all()
    reached = counts > 0
    paths = forest.level + quality._average_path(counts * 256 / fit.sum())
    assert np.allclose(forest.path[reached], paths[reached])
    kept = {r["doc_id"]: r["kept"] for r in quality.measured(docs, forest).collect()}
    assert [kept[i] for i in np.flatnonzero(fit).tolist()] == (score <= forest.threshold).tolist()


def test_language(spark, docs, no_docs):
    tongues = {
        "en": "the cat and this house with that river", "de": "der hund und das haus mit dem fluss nicht",
        "fr": "le chat et la maison avec une rivière est", "es": "el perro y la casa con una montaña los"
    }
    rng = random.Random(9)
    rows = [
        (i, " ".join(rng.choice(tongues[lang].split()) for _ in range(30)), lang, "x") for i,
        lang in enumerate([*tongues] * 40)
    ]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score string")
    held = langid.held_out_condition()
    model = langid.train(frame, training=~held)
    got = langid.predict_documents(frame, model).withColumn("held", held).collect()
    lang = {i: x for i, _, x, _ in rows}
    assert all(r["lang_pred"] == lang[r["doc_id"]] and 0.5 < r["score"] <= 1 for r in got if r["held"])
    odd = {r["doc_id"]: r for r in langid.predict_documents(docs, model).collect()}
    assert odd[0]["lang_pred"] == odd[1]["lang_pred"] == odd[2]["lang_pred"] == "und" and odd[0]["score"] == 0
    assert langid.predict_documents(no_docs, model).count() == 0
    assert langid.predict_documents(docs, langid.train(no_docs)).where("lang_pred <> 'und'").count() == 0


def test_toxicity(spark, docs, no_docs):
    rng = random.Random(10)
    bad = ["snarfle", "snarfling", "snarfed", "grumbog", "grumbogs"]
    rows = [
        (
            i, words(rng.randrange(20, 200), i) + (f" {rng.choice(bad)} " * 2 + words(10, i) if i % 3 == 0 else ""),
            i % 3 == 0
        ) for i in range(300)
    ]
    frame = spark.createDataFrame(
        [(i, t) for i, t, _ in rows] + [
            (900, words(5000, 3) + " snarflest " + words(5000, 4)), (901, words(9000, 5)), (902, None), (903, "")
        ],
        "doc_id bigint, text string"
    )
    labels = spark.createDataFrame(
        [(i, int(x)) for i, _, x in rows] + [(5, None), (7777, 1), (None, 1)], "doc_id bigint, toxic int"
    )
    held = toxicity.held_out_condition()
    got = {
        r["doc_id"]: r for r in toxicity.score_documents(
            frame, toxicity.train(frame, labels, training=~held)
        ).withColumn("held", held).collect()
    }
    judged = [(got[i]["predicted"], int(x)) for i, _, x in rows if got[i]["held"]]
    assert sum(a == b for a, b in judged) >= 0.9 * len(judged)
    assert got[900]["predicted"] == 1 and got[901]["predicted"] == got[902]["predicted"] == got[903]["predicted"] == 0
    assert all(r["predicted"] == int(r["score"] >= 0.7) for r in got.values())
    model = toxicity.train(no_docs, labels.limit(0))
    assert toxicity.score_documents(docs, model).count() == docs.count() and toxicity.score_documents(no_docs, model).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><header><h1>Site</h1></header>
<nav><ul><li><a href="/a">One</a><li><a href="/b">Two</a></ul></nav><!-- ad --><div class="ad">Buy now.</div><div id="cookie-notice">We use cookies.</div>
<article><header><h1>A &amp; B</h1></header><p><b>First   para &lt;x&gt;
goes on.<br><p>Second, with <a href='/z'>a link</a> in it.<form><input>Mail us</form><ul><li>item one<li>item two</ul><section class="comments"><p>Great!</p></section></article>
<aside>More</aside><footer>&copy; me</footer></body></html>"""


def test_html(spark):
    assert html_extract.main_text(PAGE) == "A & B\nFirst para <x> goes on.\nSecond, with a link in it.\nitem one\nitem two"
    neutral = "<body><div class=menu><a href=x>Home</a> <a href=y>News</a></div><div class=story>" + "".join(
        f"<p>{words(60, i)}, and {words(20, i)}.</p>" for i in range(5)
    ) + "</div><div><a href=z>Imprint</a></div></body>"
    text = html_extract.main_text(neutral)
    assert text.count("\n") == 4 and "Imprint" not in text and "Home" not in text
    assert html_extract.main_text("<article>cut off &amp; here <b") == "cut off & here"
    pages = spark.createDataFrame(
        [
            (1, "u", PAGE, "x"), (2, None, None, "x"), (3, "v", "", "x"), (3, "v", "", "x"),
            (None, "w", "<p>" + words(40000) + ".", "x")
        ],
        "page_id bigint, url string, html string, text string"
    )
    got = html_extract.extract(pages).collect()
    assert len(got) == 5 and all(r["n_chars"] == len(r["text"]) for r in got)
    assert {r["page_id"]: r["text"] for r in got}[None] == words(40000) + "." and sum(r["text"] == "" for r in got) == 3
    assert html_extract.extract(pages.limit(0)).count() == 0


def test_html_ratios_overrule_names():
    """All the text of a page under a name like an advert's is its text; next to nothing inside of an article goes."""
    story = "".join(f"<p>{words(60, i)}, and {words(20, i)}.</p>" for i in range(8))
    assert html_extract.main_text(f"<body><p>Go</p><div class=widget>{story}</div></body>").count("\n") == 7
    inside = html_extract.main_text(
        f"<body><article><div><div><section>{story}</section></div></div><div class=box><a href=x>More</a></div></article></body>"
    )
    assert inside.count("\n") == 7 and "More" not in inside


def test_html_scores_by_brute_force():
    """Path sums, smoothing and threshold against the definition, path by path and pair by pair."""
    rng = random.Random(4)
    for _ in range(40):
        source = "<body>"
        for _ in range(rng.randrange(1, 25)):
            source += rng.choice(
                [
                    "<div>", "<div class=a>", "</div>", "<section>", "</section>", "<p>", "</p>", "<div class=ad>",
                    "<article>", "</article>"
                ]
            )
            source += rng.choice(["", words(rng.randrange(1, 30), rng.randrange(99)) + rng.choice(["", ".", ", x."])])
        page = html_extract.parsed(source)

        def names(i):
            return [] if i <= 0 else [*names(page.paths[i].parent), page.paths[i].label]

        own = [i for i, p in enumerate(page.paths) if p.blocks]
        chain = {i: names(i) for i in own}
        base = 0
        while own and all(len(chain[i]) > base and chain[i][: base + 1] == chain[own[0]][: base + 1] for i in own):
            base += 1
        below = {i: chain[i][base:] for i in own}

        def common(a, b):
            return next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))

        def smooth(kind):
            total = {}
            for i in own:
                total[i] = sum(
                    getattr(page.paths[j], kind) * (
                        (common(below[i], below[j]) / len(below[j])) ** 2 if below[j] else i == j
                    ) for j in own
                )
            return total

        length, marks = smooth("chars"), smooth("punctuation")
        score = {}
        for i in own:
            p = page.paths[i]
            fused = length[i] / max(length.values()) * (
                1 + (marks[i] / max(marks.values()) if max(marks.values()) else 1)
            ) / 2
            score[i] = fused * (1 / 32 if p.aside else 1) * (8 if p.content else 1)
        expected = {i for i in own if score[i] >= 0.125 * min(1, max(score.values())) * (1 - 1e-9)}
        close = {i for i in own if abs(score[i] / (0.125 * min(1, max(score.values()))) - 1) < 1e-9}
        assert html_extract.chosen(page.paths) | close == expected | close


def test_html_deep_pages():
    start = time.perf_counter()
    html_extract.main_text("<div>" * 4000 + "text." + "</div>" * 4000)
    html_extract.main_text("".join(f"<div>some text {i}, yes.</b>" for i in range(4000)))
    assert time.perf_counter() - start < 2


def test_chat_query_against_sql(spark, sf_dir):
    import duckdb

    from weftline.llm import queries

    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{sf_dir}/conversations.parquet'")
    found = con.execute(queries.ORACLE_SQL["op8_chat_format"])
    names = [x[0] for x in found.description]
    assert sorted(found.fetchall()) == sorted(
        tuple(r[n] for n in names) for r in queries.QUERIES["op8_chat_format"](spark, sf_dir).collect()
    )


def test_queries_keep_every_row(spark, sf_dir):
    from weftline.llm import queries

    n = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet").count() for t in ("documents", "pages", "embeddings")}
    for name, f in queries.QUERIES.items():
        if name.startswith("op8") or name == "pipeline":
            continue
        table = "pages" if name.startswith("op4") else "embeddings" if name.startswith("op10") else "documents"
        assert f(spark, sf_dir).count() == n[table], name


def test_pipeline_stages(spark, sf_dir):
    """Each stage against a plain version of what it decides, on all its predecessor kept."""
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    toxic, dedup, private, mix, encode = [f for _, f in P.STAGES]
    clean = toxic(spark, docs, sf_dir)
    model = toxicity.train(
        docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), training=~toxicity.held_out_condition()
    )
    scores = toxicity.score_documents(docs, model)
    assert sorted(r["doc_id"] for r in clean.collect()) == sorted(
        r["doc_id"] for r in scores.where("predicted = 0").collect()
    )
    clean = clean.persist()
    kept = dedup(spark, clean, sf_dir).persist()
    found = simhash.near_duplicates(clean)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({r["component_id"] for r in found.collect()})
    masked = private(spark, kept, sf_dir).persist()
    plain = {r["doc_id"]: r["text"] for r in pii.pseudonymised(kept, P.PII_KEY).collect()}
    assert {
        r["doc_id"]: (r["text"], r["n_chars"]) for r in masked.collect()
    } == {k: (v, len(v)) for k, v in plain.items()}
    mixed = mix(spark, masked, sf_dir).persist()
    copies = {r["doc_id"]: r["copies"] for r in mixing.with_copies(masked).collect() if r["copies"]}
    assert Counter(r["doc_id"] for r in mixed.collect()) == Counter(copies)
    for frame in (clean, kept, masked, mixed):
        assert frame.columns == docs.columns and frame.count() > 0
    ids = encode(spark, mixed, sf_dir).collect()
    assert Counter(r["doc_id"] for r in ids) == Counter(copies)
    text = {r["doc_id"]: r["text"] for r in masked.collect()}
    assert all(
        r["decoded_sha256"] == hashlib.sha256(
            text[r["doc_id"]].encode()
        ).hexdigest() and len(r["ids"]) == r["n_tokens"] for r in ids
    )


def test_pipeline_takes_odd_rows(spark, docs, sf_dir):
    import corpus_pipeline as P

    frame = docs.select(
        "doc_id", "text", "lang", "source", F.col("n_chars"), F.lit(1).alias("predicted"), F.lit(2).alias("key")
    )
    for start in (frame, frame.limit(0)):
        for name, f in P.STAGES:
            start = f(spark, start, sf_dir).persist()
            start.count()


def test_pipeline_keeps_a_row_of_each_component(spark, sf_dir):
    """Null ids and ids with several texts: no component of texts is lost, and none stays twice."""
    import corpus_pipeline as P

    a, b, c, d = (words(80, i) for i in range(20, 24))
    rows = [
        (1, a), (1, a), (None, a), (1, b), (2, b), (None, c), (None, c), (None, d), (3, ""), (None, None), (4, c[::-1]),
        (4, d[::-1])
    ]
    frame = spark.createDataFrame(
        [(i, t, "en", "s", None) for i, t in rows],
        "doc_id bigint, text string, lang string, source string, n_chars bigint"
    )
    got = P.drop_near_duplicates(spark, frame, sf_dir)
    assert got.columns == P.COLUMNS
    assert Counter((r["doc_id"], r["text"]) for r in got.collect()) == Counter(
        [(1, a), (1, b), (None, c), (None, d), (3, ""), (4, c[::-1]), (4, d[::-1])]
    )
    assert P.drop_near_duplicates(spark, frame.limit(0), sf_dir).count() == 0


def plain_ngrams(word, sizes, buckets):
    """Buckets of the character n-grams of a word, one by one."""
    points = [ord(c) for c in f"<{word}>"]
    for n in sizes:
        for at in range(len(points) - n + 1):
            mixed = 0x9E3779B1 * n & 0xFFFFFFFF
            for c in points[at : at + n]:
                mixed = (mixed ^ c) * 0x01000193 & 0xFFFFFFFF
                mixed ^= mixed >> 15
            mixed = mixed * 0x85EBCA6B & 0xFFFFFFFF
            mixed ^= mixed >> 13
            yield mixed & (buckets - 1)


SAID = [
    "the cat and this house", "der hund und das haus mit", "le chat et la maison une", "el perro y la casa una", "",
    "12 34", "ç€😀 straße", "the the the der"
]


def test_language_by_brute_force():
    """Duels, families first, text by text and n-gram by n-gram."""
    langs = ["en", "de", "fr", "es"]
    model = langid.fit([f"{t} {w}" for t in SAID[:4] for w in "abcdef"], [x for x in langs for _ in "abcdef"])
    for text, got, score in zip(SAID, *model.predict(SAID)):
        grams = [
            b for w in re.findall(
                r"[^\x20\x09-\x0D]+", text.lower()
            ) for b in plain_ngrams(w, langid.SIZES, langid.BUCKETS)
        ]
        sure = {}
        for k, pair in enumerate(model.pairs):
            margin = langid.SCALE * sum(float(model.weights[b, k]) for b in grams) / max(1, len(grams)) + model.bias[k]
            sure[pair] = 1 / (1 + math.exp(-max(-50, min(50, 2 * margin))))

        def duel(names):
            won = {
                n: sum(
                    p if n == a else 1 - p for (a, b), p in sure.items() if n in (a, b) and {a, b} <= set(names)
                ) for n in names
            }
            wins = {
                n: sum(
                    (p >= 0.5) == (n == a) for (a, b), p in sure.items() if n in (a, b) and {a, b} <= set(names)
                ) for n in names
            }
            best = max(names, key=lambda n: (wins[n] + won[n] / len(names)))
            return best, won[best] / (len(names) - 1) if len(names) > 1 else 1.0

        own, certainty = duel(sorted({langid.family(x) for x in langs}))
        lang, more = duel(sorted(x for x in langs if langid.family(x) == own))
        expected = (lang, certainty * more) if any(map(str.isalpha, text)) else ("und", 0.0)
        assert got == expected[0] and score == pytest.approx(expected[1], abs=1e-5)


def test_toxicity_by_brute_force():
    """The most toxic passage, word by word and n-gram by n-gram."""
    bad = [f"you snarfle{x} grumbog" for x in ("", "d", "s", "r")] * 6
    good = [words(12, i) for i in range(24)]
    model = toxicity.fit(bad + good, [1] * 24 + [0] * 24)
    s = model.settings
    texts = [
        words(100, 3) + " snarfling grumbogs " + words(90, 4), "", "snarfle snarfle snarfle", words(20, 5), None or "x"
    ]
    for text, got in zip(texts, model.score(texts)):
        said = re.findall(r"[^\x20\x09-\x0D]+", text.lower())
        said = [w for i, w in enumerate(said) if not i or w != said[i - 1]]
        logit = []
        for w in said:
            grams = list(plain_ngrams(w, toxicity.SIZES, s.buckets))
            logit.append(sum(float(model.weights[b]) for b in grams) / max(1, len(grams)))
        half, size = s.passage // 2, s.passage
        spans = [logit[at : at + size] for at in range(0, max(1, len(logit) - half), half)] or [[]]
        most = max(sum(x) / max(len(x), size // 4) for x in spans) + model.bias
        assert got == pytest.approx(1 / (1 + math.exp(-max(-60, min(60, most)))), abs=1e-4)


def test_mixing_copies_by_brute_force(spark):
    """Copies of every source and size against a plain solution of the dual and plain systematic rounding."""
    rng = random.Random(3)
    rows = [(i, rng.choice("abcde"), words(rng.choice([0, 1, 3, 8, 20, 55]), i)) for i in range(600)]
    frame = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    got = mixing.with_copies(frame).select("doc_id", "size", "target", "copies", "taken").collect()
    by_id = {r["doc_id"]: r for r in got}
    sized = defaultdict(Counter)
    for i, source, text in rows:
        n = len(text.split())
        assert by_id[i]["size"] == n and by_id[i]["taken"] == by_id[i]["copies"] * n
        sized[source][n] += 1
    total = {k: sum(n * m for n, m in c.items()) for k, c in sized.items()}
    weight = {k: i % 3 + 1 for i, k in enumerate(sorted(sized))}
    goal, free, left = {}, set(sized), float(sum(total.values()))
    while free:
        level = left / sum(weight[k] for k in free)
        over = {k for k in free if level * weight[k] > 3 * total[k]}
        for k in over or free:
            goal[k] = 3 * total[k] if over else level * weight[k]
        left -= sum(goal[k] for k in over or free)
        free -= over or free
    phases = spark.createDataFrame([(k,) for k in sized], "k string").select(
        "k", (F.pmod(F.xxhash64(mixing.source_key(F.col("k")), F.lit("phase")), F.lit(1 << 20)) / (1 << 20)).alias("p")
    )
    for k, phase in phases.collect():
        mean, cells = total[k] / sum(sized[k].values()), sized[k]

        def rate(n, tilt):
            return min(3.0, math.exp(min(50.0, tilt * n / mean)))

        low, high = -400.0, 400.0
        for _ in range(200):
            tilt = (low + high) / 2
            low, high = (low, tilt) if sum(n * m * rate(n, tilt) for n, m in cells.items()) > goal[k] else (tilt, high)
        at = phase
        for n in sorted(cells):
            exact = rate(n, tilt) if goal[k] < 3 * total[k] else 3.0
            whole = math.floor(exact + 1e-9)
            end = at + cells[n] * max(0.0, exact - whole)
            copies = sum(by_id[i]["copies"] for i, source, text in rows if source == k and len(text.split()) == n)
            expected = cells[n] * whole + math.floor(end) - math.floor(at)
            assert copies == expected or abs(end - round(end)) < 1e-4
            assert all(by_id[i]["target"] == pytest.approx(goal[k]) for i, source, _ in rows if source == k)
            at = end
