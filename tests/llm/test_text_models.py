"""Personal data, toxicity, quality, mixing, chats and the pipeline."""

from __future__ import annotations

import random
import re
import zlib
from collections import defaultdict
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from legalops.llm import chat, mixing, pii, quality, toxicity

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(digits):
    each = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in each) % 10 == 0


def _base(text):
    found = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and _luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            found.append(f"{kind}:{m.start()}:{m.end()}")
    return found


def test_base_spans_equal_plain_patterns(spark):
    rng = random.Random(1)
    pieces = ["a@b.c", "x@y", ".", "@", "_", "1.2.3.4", "300.1.1.1", "4539 1488 0343 6467", "4539148803436467", "+1 (234) 555-1234", "+", "555", " ", "é🎉", "-", "at", "(", "1", "j [at] k.com", "234-555-1234", "00000000000000000000"]
    texts = [None, "", "a" * 20000, "1." * 5000, "+1" + " " * 5000, "1 " * 5000] + ["".join(rng.choice(pieces) for _ in range(rng.randrange(12))) for _ in range(300)]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts + texts[:2])], "doc_id long, text string, spans string")
    found = {r["doc_id"]: r for r in pii.personal_data_digests(df).collect()}
    assert len(found) == len(texts) + 2
    for i, text in enumerate(texts):
        want = _base(text or "")
        assert found[i]["base_sha256"] == sha256(",".join(want).encode()).hexdigest(), text
        assert set(want) <= set(filter(None, found[i]["spans"].split(",")))
        assert [found[i][f"n_{k}"] for k in PATTERNS] == [sum(w.startswith(k) for w in want) for k in PATTERNS]
    assert pii.personal_data_digests(df.where("false")).collect() == []


def test_a_text_with_very_many_matches(spark):
    n = 20_000
    label = "x@" + "a." * 100_000 + "com"
    many = " ".join(f"u{k}@m{k % 7}.com" for k in range(n))
    loose = " ".join(f"u{k} [at] m{k % 7}.com" for k in range(n))
    df = spark.createDataFrame([(1, label), (2, many), (3, many + " " + loose)], "doc_id long, text string")
    found = {r["doc_id"]: r for r in pii.find_personal_data(df).collect()}
    assert [tuple(x) for x in found[1]["base"]] == [(0, 0, len(label))]
    want = [(0, m.start(), m.end()) for m in re.finditer(PATTERNS["email"], many)]
    assert [tuple(x) for x in found[2]["base"]] == want == [tuple(x) for x in found[3]["base"]]
    assert set(want) <= {tuple(x) for x in found[3]["spans"]}


def test_proposed_spans_stay_apart_from_base_spans(spark):
    rng = random.Random(5)
    both = []
    for _ in range(300):
        spans = []
        for base in (True, False):
            at = 0
            for _ in range(rng.randrange(6)):
                s = at + rng.randrange(4)
                at = s + rng.randrange(1, 9)
                spans.append((rng.choice([0, 0, 1]), s, at, base))
        both.append((spans,))
    df = spark.createDataFrame(both, "found array<struct<kind:int,s:int,e:int,base:boolean>>")
    for r in df.select("found", F.array(*[pii._apart(F.col("found"), k) for k in (0, 1)]).alias("apart")).collect():
        for kind in (0, 1):
            own = [x for x in r["found"] if x["kind"] == kind]
            want = [x for x in own if not x["base"] and not any(b["base"] and b["s"] < x["e"] and x["s"] < b["e"] for b in own)]
            assert sorted(r["apart"][kind]) == sorted(want)


def test_votes_and_classifier_add_spans_that_labelers_agree_on(spark):
    rng = random.Random(2)
    texts = [f"mail me at user{k}@mail{k % 5}.com or phone +1 234 555-1{k:03d} today" for k in range(200)]
    texts += [f"version {rng.randrange(9)}.{rng.randrange(9)}.{rng.randrange(300, 900)}.1 item 1234-1{k:05d}" for k in range(200)]
    texts += ["contact by mail user [at] site.com", "call 234-555-1234 now"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["spans"] for r in pii.personal_data_digests(df).collect()}
    assert found[401] == "phone:5:17"
    belief = pii.fit_votes({(0, 1, 1, 1): 90, (0, 1, 1, 0): 50, (0, 2, 2, 2): 80, (0, 2, 1, 0): 5})
    assert belief[0, 1, 1, 1] > 0.9 > 0.1 > belief[0, 2, 2, 2]


def _labelled(n=900):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice(["ta", "ne", "or", "shi", "ble", "con"]) for _ in range(rng.randrange(1, 5)))
    rows, labels = [], []
    for i in range(n):
        words = [word() for _ in range(60)]
        toxic, good = int(i % 5 == 0), int(i % 7 != 0)
        if toxic:
            insult = rng.choice(["grumfitz", "wexmuddle", "pifflegab"])
            forms = [insult, insult, insult, insult[:4] + "x" + insult[4:], ".".join(insult), " ".join(insult)]
            words.insert(rng.randrange(60), rng.choice(forms))
        if not good:
            words = [w + "$$$" for w in words]
        rows.append((i, " ".join(words), "s", "p" if i % 2 else None))
        labels.append((i, good, toxic))
    return rows, labels


def test_toxicity_on_held_out_rows(spark):
    rows, labels = _labelled()
    rows += [(9001, None, "s", "p"), (9002, "", "s", "p"), (9003, "a b", "s", "p"), (None, "tane", "s", "p")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, host string, score string")
    marks = spark.createDataFrame(labels + [(5, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    found = {r["doc_id"]: r for r in toxicity.score(docs, marks).collect()}
    assert len(found) == len(rows)
    held = [(found[i]["predicted"], t) for i, _, t in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(found[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, _, _ in labels)
    assert np.mean([p == t for p, t in held]) > 0.95
    assert all(found[i]["predicted"] == 0 and 0 <= found[i]["score"] < 0.5 for i in (9001, 9002, 9003, None))
    one_class = toxicity.score(docs, marks.where("toxic = 0")).collect()
    assert {(r["score"], r["predicted"]) for r in one_class} == {(0.0, 0)}
    assert toxicity.score(docs.where("false"), marks).collect() == []


def test_toxicity_over_word_boundaries(spark):
    rows, labels = _labelled()
    # An insult of three labelled texts alone, and one of two words that are clean apart.
    for k, (i, text, *rest) in enumerate(rows):
        if labels[i][2] and k < 45:
            clean = " ".join(w for w in rows[i + 1][1].split())
            rows[k] = (i, f"{clean[:90]} zorkbludge {clean[90:]}", *rest)
    clean = rows[1][1]
    spaced = ["g. r. u. m. f. i. t. z.", "g  r  u  m  f  i  t  z", "grum fitz", "pif fle\ngab", "wexm, uddle", "zorkbludge", "z o r-k b l u d g e"]
    rows += [(5000 + k, f"{clean[:100]} {form} {clean[100:]}", "s", "p") for k, form in enumerate(spaced)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, host string, path string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = {r["doc_id"]: r["predicted"] for r in toxicity.score(docs, marks).collect()}
    assert found[1] == 0
    assert {form: found[5000 + k] for k, form in enumerate(spaced)} == dict.fromkeys(spaced, 1)
    # A three-letter word that is spelled out is a window too.
    assert any(n == 3 for *_, length, _ in toxicity.Scorer(np.zeros(64**3), 0.0).windows([toxicity.stream("a. s  s")]) for n in length)


def test_texts_of_a_batch_are_not_all_held_as_streams():
    drawn = []
    texts = (drawn.append(k) or toxicity.stream("some words here " * 5000) for k in range(12))
    found = toxicity.Scorer(np.zeros(64**3), 0.0).windows(texts)
    _, text, *_ = next(found)
    assert set(text) == set(range(len(drawn) - 1)) and len(drawn) < 5
    assert set(np.concatenate([text, *[t for _, t, *_ in found]])) == set(range(12))


def test_quality_on_held_out_rows_and_shrinking(spark):
    rows, labels = _labelled()
    rows += [(9001, None, None, None), (9002, "", "rare", "p")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, host string, path string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = {r["doc_id"]: r for r in quality.score(docs, marks, "host", "path").collect()}
    assert len(found) == len(rows)
    held = [(found[i]["predicted"], g) for i, g, _ in labels if found[i]["held_out"]]
    assert np.mean([p == g for p, g in held]) > 0.95
    # One document moves its site less than many do.
    share = np.mean([g for _, g, _ in labels])
    assert abs(found[9002]["host_rate"] - share) < 0.5
    assert quality.score(docs.where("false"), marks, "host", "path").collect() == []


def test_site_posteriors_equal_plain_python_on_sites_that_differ(spark):
    rng = random.Random(9)
    rates = {"a": 0.95, "b": 0.1, "c": 0.6, None: 0.5, "d": 0.9, "e": 0.3}
    rows, labels = [], []
    for i in range(1500):
        host = rng.choice(list(rates))
        path = rng.choice(["p", "q", None])
        # Some paths differ from their hosts. Texts say little, so the sites have to.
        good = int(rng.random() < (1 - rates[host] if path == "q" and host in "ab" else rates[host])) if host else rng.randrange(2)
        words = [rng.choice(["tane", "shi", "ble", "conor"]) for _ in range(rng.randrange(20, 60))]
        if good and rng.random() < 0.3:
            words = [w.capitalize() for w in words]
        rows.append((i, " ".join(words), host, path))
        if i % 3:
            labels.append((i, good))
    rows += [(5, rows[5][1], "a", "p"), (None, "x", "b", "p"), (3000, "y " * 200_000, "c", "q"), (3001, "", "lonely", "z")]
    docs = spark.createDataFrame([(*r, 1, 1.0) for r in rows], "doc_id long, text string, host string, path string, n int, score double")
    found = quality.score(docs, spark.createDataFrame(labels, "doc_id long, quality int"), "host", "path").collect()
    assert len(found) == len(rows)

    learned = {i: g for i, g in labels if zlib.crc32(str(i).encode()) % 5}
    by_id = {r["doc_id"]: r for r in found}
    train = [learned[r[0]] for r in rows if r[0] in learned]
    prior = np.log(sum(train) / (len(train) - sum(train)))
    logistic = lambda x: 1 / (1 + np.exp(-x))
    says = [float(learned[i]) if i in learned else logistic(by_id[i]["evidence"] + prior) for i, *_ in rows]

    def sums(key):
        held = defaultdict(lambda: [0.0, 0])
        for r, v in zip(rows, says):
            held[key(r)][0] += v
            held[key(r)][1] += 1
        return held

    def strength(sites, toward):
        big = [(g / n, n, toward(k)) for k, (g, n) in sites.items() if n >= 5]
        mean = np.mean([x for x, _, _ in big])
        spread = np.var([x - t for x, _, t in big], ddof=1) - np.mean([x * (1 - x) / n for x, n, _ in big])
        return max(1.0, mean * (1 - mean) / spread - 1)

    hosts, paths = sums(lambda r: r[2]), sums(lambda r: r[2:])
    whole = sum(says) / len(says)
    kh = strength(hosts, lambda k: whole)
    kp = strength(paths, lambda k: (hosts[k[0]][0] + kh * whole) / (hosts[k[0]][1] + kh))
    for r, v in zip(rows, says):
        host = (hosts[r[2]][0] - v + kh * whole) / (hosts[r[2]][1] - 1 + kh)
        path = (paths[r[2:]][0] - v + kp * host) / (paths[r[2:]][1] - 1 + kp)
        want = logistic(by_id[r[0]]["evidence"] + prior + np.log(path / (1 - path)) - np.log(whole / (1 - whole)))
        got = by_id[r[0]]
        assert np.allclose([got["host_rate"], got["path_rate"], got["score"]], [host, path, want], atol=1e-9) or r[0] == 5
    # A lone document has the rate above its site; the sites decide where texts do not.
    assert abs(by_id[3001]["path_rate"] - whole) < 1e-9
    out = [(by_id[i], g) for i, g in labels if by_id[i]["held_out"]]
    text_alone = np.mean([(r["evidence"] + prior >= 0) == bool(g) for r, g in out])
    assert np.mean([r["predicted"] == g for r, g in out]) > text_alone + 0.1


def _targets(sizes):
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weights = {s: k % 3 + 1 for k, s in enumerate(names)}
    capped: set = set()
    while True:
        rest = sum(sizes.values()) - sum(3 * sizes[s] for s in capped)
        free = sum(w for s, w in weights.items() if s not in capped)
        targets = {s: 3 * sizes[s] if s in capped else rest * weights[s] / free for s in names}
        over = {s for s in names if s not in capped and targets[s] > 3 * sizes[s]}
        if not over:
            return targets
        capped |= over


def test_mixing(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_WORDS", 3000)
    rng = random.Random(5)
    rows = [(i, "w " * rng.randrange(120), rng.choice(["a", "a", "a", "b", "Ä", None, "tiny"] if i % 50 == 0 else ["a", "b", None])) for i in range(600)]
    rows += [(700, None, "empty"), (701, "big " * 20000, "b"), (702, "w w", "b"), (702, "w w", "b"), (None, "w", "a")]
    df = spark.createDataFrame([(i, t, s, 1) for i, t, s in rows], "doc_id long, text string, source string, size int")
    found = mixing.mix_words(df).collect()
    again = mixing.mix_words(df.repartition(5)).collect()
    key = lambda r: (r["doc_id"] is None, r["doc_id"], r["taken"])
    assert sorted(found, key=key) == sorted(again, key=key) and len(found) == len(rows)
    sizes, taken, source = defaultdict(int), defaultdict(int), {}
    for i, t, s in rows:
        sizes[s] += len((t or "").split())
        source[i] = s
    targets = _targets(dict(sizes))
    for r in found:
        s = source[r["doc_id"]]
        taken[s] += r["taken"]
        assert r["taken"] <= 3 * r["size"] and r["source_size"] == sizes[s]
        assert abs(r["target"] - targets[s]) < 1e-6 * max(1, targets[s])
    for s in targets:
        assert abs(taken[s] - targets[s]) <= 2 * mixing.BLOCK_WORDS, s
    whole = mixing.mix(df).collect()
    assert {r.asDict().keys() == {"doc_id", "text", "source", "size"} for r in whole} == {True}
    assert mixing.mix_words(df.where("false")).collect() == []


def test_sainte_lague_equals_seat_by_seat(spark):
    rng = random.Random(6)
    for seats in (0, 1, 7, 100, 1001):
        votes = [(g, k, float(rng.randrange(1000))) for g in range(3) for k in range(12)] + [(3, 0, 0.0)]
        df = spark.createDataFrame([(*v, seats) for v in votes], "g int, k int, v double, seats long")
        found = {(r["g"], r["k"]): r["quota"] for r in mixing.sainte_lague(df, ["g"], ["k"], "v", "seats").collect()}
        for g in range(3):
            own = {k: v for gg, k, v in votes if gg == g}
            won = dict.fromkeys(own, 0)
            for _ in range(seats):
                best = max(own, key=lambda k: (own[k] / (2 * won[k] + 1), -k))
                won[best] += 1
            assert {k: found[g, k] for k in own} == won
        assert found[3, 0] == 0


def test_chats_read_back(spark):
    rows = [(1, 0, "user", "hi <|im_end|>\n"), (1, 1, "assistant", "[INST] \\<\\ </s>"), (1, 2, "user", None), (1, 3, "assistant", ""), (1, 4, "assistant", "é🎉"), (1, 5, "user", "bye")]
    rows += [(2, 0, "odd\nrole[n<", "x"), (None, None, None, "y"), (3, 0, "assistant", "same"), (3, 0, "assistant", "same")]
    df = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, segment string")
    made = chat.segments(df)
    found = {r["conv_id"]: r for r in chat.read_back(made).collect()}
    for conv in (1, 2, None, 3):
        own = [r for r in rows if r[0] == conv]
        turns = "".join(f"{r or ''}\n{t or ''}\n" for _, _, r, t in own)
        loss = "".join(t or "" for _, _, r, t in own if r == "assistant")
        got = found[conv]
        assert (got["n_turns"], got["loss_chars"]) == (len(own), len(loss))
        assert got["turns_sha256"] == sha256(turns.encode()).hexdigest()
        assert got["loss_sha256"] == sha256(loss.encode()).hexdigest()
    texts = {r["example"]: r for r in chat.example_texts(made.where("conv_id = 1")).collect()}
    stream = [r["segment"] for r in made.where("conv_id = 1").orderBy("start").collect()]
    assert {k: r["context"] + r["target"] for k, r in texts.items()} == {1: "".join(stream[:2]), 2: "".join(stream[:4]), 3: "".join(stream[:5])}
    assert not re.search(r"</s>|\[INST\]", "".join(stream))
    # Each example is its conversation, the length of its context and its target.
    held = {r["example"]: r for r in chat.examples(made.where("conv_id = 1")).collect()}
    assert {k: (r["prefix_chars"], r["target"]) for k, r in held.items()} == {k: (len(r["context"]), r["target"]) for k, r in texts.items()}
    assert chat.read_back(chat.segments(df.where("false"))).collect() == []


def test_a_conversation_of_very_many_and_very_long_turns(spark):
    rows = [(1, k, "assistant" if k % 2 else "user", f"turn {k} <") for k in range(6000)]
    rows += [(2, 0, "user", "long [" * 100_000), (2, 1, "assistant", "é" * 500_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = chat.segments(df)
    assert chat.examples(made).count() == 3001
    found = {r["conv_id"]: r for r in chat.read_back(made).collect()}
    for conv in (1, 2):
        own = [r for r in rows if r[0] == conv]
        loss = "".join(t for _, _, r, t in own if r == "assistant")
        assert (found[conv]["n_turns"], found[conv]["loss_chars"]) == (len(own), len(loss))
        assert found[conv]["loss_sha256"] == sha256(loss.encode()).hexdigest()


def _talk(n):
    rows = [(1, k, "assistant" if k % 3 else "user", f"turn {k} <[é🎉" + "x" * (k % 7)) for k in range(n)]
    rows += [(2, 0, "user", "hi"), (2, 1, "assistant", "ho"), (None, 0, "assistant", "a"), (None, 1, "odd\n[n", "b"), (3, 0, "user", "no reply")]
    return rows


@pytest.mark.parametrize("written, held", [(1 << 28, 1 << 24), (5000, 100), (1, 1)])
def test_every_example_is_written_out_once_in_blocks(spark, monkeypatch, tmp_path, written, held):
    monkeypatch.setattr(chat, "WRITTEN", written)
    monkeypatch.setattr(chat, "HELD", held)
    monkeypatch.setattr(chat, "PIECE", held)
    log, real = str(tmp_path / "log"), chat.read_example

    def read_example(stream, upto, target):
        found = real(stream, upto, target)
        with open(log, "a") as f:
            f.write(f"{upto} {len(target)} {found[0]} {found[2]}\n")
        return found

    monkeypatch.setattr(chat, "read_example", read_example)
    rows = _talk(90)
    made = chat.segments(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    found = {r["conv_id"]: r for r in chat.read_back(made).collect()}
    assert set(found) == {1, 2, 3, None}
    for conv, got in found.items():
        own = [r for r in rows if r[0] == conv]
        loss = "".join(t for _, _, r, t in own if r == "assistant")
        assert (got["n_turns"], got["loss_chars"]) == (len(own), len(loss))
        assert got["turns_sha256"] == sha256("".join(f"{r}\n{t}\n" for _, _, r, t in own).encode()).hexdigest()
        assert got["loss_sha256"] == sha256(loss.encode()).hexdigest()
    # The number of an example's turns and its code points, with its whole context.
    parts = {c: [r["segment"] for r in made.where(F.col("conv_id").eqNullSafe(c)).orderBy("start").collect()] for c in found}
    want = [(k + 1, len("".join(p[: k + 1]))) for c, p in parts.items() for k, t in enumerate(p) if t.startswith(chat.OPEN + "assistant\n")]
    with open(log) as f:
        assert sorted(tuple(map(int, line.split()[2:])) for line in f) == sorted(want)
    assert len(want) == 62


@pytest.mark.parametrize("written", [1 << 28, 1])
def test_a_context_that_does_not_read_back_is_an_error(spark, monkeypatch, written):
    monkeypatch.setattr(chat, "WRITTEN", written, raising=False)
    made = chat.segments(spark.createDataFrame(_talk(9), "conv_id long, turn long, role string, text string"))
    # As long as before, but with control strings in it: the context has a turn more than the conversation.
    false = chat.CLOSE + chat.OPEN + "s\n"
    long = made.where("conv_id = 1 AND turn = 3").withColumn("segment", F.concat(F.lit("<|im_start|>user\n" + false), F.repeat(F.lit("y"), F.length("segment")), F.lit(chat.CLOSE)))
    added = F.when((F.col("conv_id") == 1) & (F.col("turn") > 3), long.select(F.length("segment")).scalar() - made.where("conv_id = 1 AND turn = 3").select(F.length("segment")).scalar()).otherwise(0)
    broken = made.where("NOT (conv_id <=> 1 AND turn = 3)").withColumn("start", F.col("start") + added).unionByName(long)
    with pytest.raises(Exception, match="does not read back as its turns|not made of whole turns"):
        chat.read_back(broken).collect()
    # A reply whose example is missing.
    with pytest.raises(Exception, match="in no example"):
        chat.read_back(made.withColumn("example", F.when(~((F.col("conv_id") == 1) & (F.col("turn") == 4)), F.col("example")))).collect()


def test_pipeline_stages_on_a_small_folder(spark, tmp_path):
    rows, labels = _labelled(400)
    # Long copies, so that one changed word leaves a similarity of over 0.8.
    base = [f"{rows[2][1]} {rows[3][1]} {rows[6][1]}", f"{rows[7][1]} {rows[8][1]} {rows[11][1]}"]
    texts = [(i, t, "src") for i, t, _, _ in rows] + [(1000, base[0], "src"), (1001, base[0] + " ", "src"), (1002, base[0].replace("  ", " "), "src"), (1003, base[0] + " tail", "src"), (1004, base[1], None)]
    spark.createDataFrame([(i, t, "en", s, len(t)) for i, t, s in texts], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    toxic = {i for i, _, t in labels if t}
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    clean = stages["toxicity"](spark, docs, str(tmp_path))
    assert clean.columns == docs.columns
    left = {r["doc_id"] for r in clean.select("doc_id").collect()}
    assert len(left & toxic) <= 4 and len({i for i, _, _ in texts} - left - toxic) <= 4
    single = stages["near_dedup"](spark, stages["exact_dedup"](spark, docs, str(tmp_path)), str(tmp_path))
    assert single.columns == docs.columns
    kept = {r["doc_id"] for r in single.select("doc_id").collect()}
    assert 1000 in kept and not kept & {1001, 1002, 1003}
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    library = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.VOCABULARY))
    text_of = {i: t for i, t, _ in texts}
    assert out and {r["doc_id"] for r in out} <= left
    for r in out:
        ids = library.encode(text_of[r["doc_id"]], add_special_tokens=False).ids
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r["decoded_sha256"] == sha256(text_of[r["doc_id"]].encode()).hexdigest()
