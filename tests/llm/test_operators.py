"""Each operator against a plain brute-force version."""

from __future__ import annotations

import hashlib
import json
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from timeloom.llm import chat, components, jaccard, mixing, packing, pii, quality, repeats, textops, toxicity, vectors, wordpiece
from timeloom.llm.queries import tokenizer_file

ASCII = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text) -> list[bytes]:
    return ASCII.findall((text or "").encode())


def rows(docs) -> list[tuple]:
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


# 1

@pytest.mark.parametrize("seed", range(6))
def test_patterns_hold_every_item(seed):
    rng = random.Random(seed)
    counts = {rng.randint(1, 64): rng.randint(1, 50) for _ in range(rng.choice([1, 5, 40]))}
    used, bins = Counter(), 0
    for n, items in packing.plan_patterns(counts, 64):
        assert sum(s * k for s, k in items) <= 64
        assert sum(k for s, k in items if s > 64 / 3) <= 2
        for s, k in items:
            used[s] += n * k
        bins += n
    assert used == Counter(counts)
    assert bins <= first_fit([s for s, c in counts.items() for _ in range(c)], 64) * 1.05 + 1


def first_fit(sizes, capacity):
    """Bins of first fit decreasing."""
    left: list[int] = []
    for s in sorted(sizes, reverse=True):
        for i, g in enumerate(left):
            if g >= s:
                left[i] -= s
                break
        else:
            left.append(capacity - s)
    return len(left)


def test_pieces_are_whole_texts_and_packing_has_no_gaps(spark, docs, scratch):
    from tokenizers import Tokenizer

    path = tokenizer_file("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    pieces = scratch.save(packing.tokenized_pieces(docs, path, 256), "pieces")
    placed = packing.pack_best_fit(pieces.withColumn("crc", F.crc32("ids")), "length", 256, ["doc_id", "piece", "start", "crc"]).collect()
    got = defaultdict(list)
    for r in pieces.collect():
        assert r.start == 0 if r.piece == 0 else r.length == 256
        got[r.doc_id].append((r.piece, r.start, bytes(r.ids)))
    want = defaultdict(list)
    for d, text in rows(docs):
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 0], "<u4").tobytes()
        want[d].append(ids)
    for d, texts in want.items():
        whole = b"".join(x for _, _, x in sorted(got[d]))
        assert len(whole) == sum(map(len, texts))
        if len(texts) == 1:
            assert whole == texts[0]
    places = defaultdict(list)
    for r in placed:
        places[r.sequence_id].append((r.offset, r.length))
    for items in places.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= 256
    assert len(placed) == pieces.count()
    assert len(places) <= first_fit([r.length for r in placed], 256) + 1


def test_query_gives_added_tokens_their_ids(spark, tmp_path):
    from tokenizers import Tokenizer

    import corpus_pipeline
    from timeloom.llm import queries

    t = Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))
    assert 50256 in t.encode("end <|endoftext|> of", add_special_tokens=False).ids
    data = [(0, "end <|endoftext|> of"), (1, "<|endoftext|>"), (2, "a  b <|endoftext|><|endoftext|>  日本 c"), (3, "<|endoftext |> no token"), (4, "plain text"), (5, None)]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    want = {}
    for d, text in data:
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        want[d] = (len(ids), zlib.crc32(ids.tobytes()))
    for placed in (queries.op1_best_fit_packing(spark, str(tmp_path)), corpus_pipeline.pack(spark, docs, str(tmp_path))):
        assert {r.doc_id: (r.length, r.ids_crc32) for r in placed.collect()} == want


def test_packing_of_clashing_names(spark, scratch):
    rows = scratch.save(spark.createDataFrame([(i, 1 + i % 9, i, i, i, i, i, i) for i in range(200)], "doc_id long, _length int, _salt int, _in int, _rank int, _before int, sequence_id int, offset string"), "clash")
    out = packing.pack_best_fit(rows, "_length", 10, ["doc_id"])
    assert sorted(out.columns) == sorted(rows.columns)
    places = defaultdict(list)
    for r in out.collect():
        assert r._salt == r._in == r._rank == r._before == r.doc_id
        places[r.sequence_id].append((r.offset, r._length))
    for items in places.values():
        assert sum(n for _, n in items) <= 10 and [at for at, _ in sorted(items)] == [sum(n for _, n in sorted(items)[:i]) for i in range(len(items))]
    with pytest.raises(ValueError):
        packing.pack_best_fit(rows, "_length", 8, ["doc_id"])


def test_packing_nothing(spark, empty, scratch):
    pieces = scratch.save(packing.tokenized_pieces(empty, tokenizer_file("byte_bpe_50k.json"), 64), "none")
    assert packing.pack_best_fit(pieces, "length", 64, ["doc_id"]).count() == 0


# 2

def brute_repeats(data, window):
    first = {}
    for d, t in data:
        w = words(t)
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            if d is not None:
                first[key] = min(first.get(key, d), d)
    out = []
    for d, t in data:
        w = words(t)
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if d is not None and first[tuple(w[i : i + window])] < d:
                gone[i : i + window] = [True] * window
        out.append((d, len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone) if not g)).hexdigest()))
    return sorted(out, key=str)


def test_repeats(spark, docs, scratch):
    found = repeats.remove_repeats(docs, scratch).drop("text", "passages").collect()
    assert sorted(map(tuple, found), key=str) == brute_repeats(rows(docs), 50)
    assert any(r.n_removed for r in found)


def test_repeats_short_windows(spark, docs, scratch):
    found = repeats.remove_repeats(docs, scratch, window=8, seed_words=3).drop("text", "passages").collect()
    assert sorted(map(tuple, found), key=str) == brute_repeats(rows(docs), 8)


def test_repeats_of_a_seed_within_a_text(spark, scratch):
    """Runs of far more windows than one run holds, and windows wider than a run."""
    data = [(1, "a b " * 400), (2, "x " + "a b " * 300 + "y"), (3, "b " * 500), (4, "q " + "b " * 200 + "a b " * 90), (5, "z " * 10 + "a b " * 60)]
    for window, seed_words in ((20, 4), (150, 10)):
        found = repeats.remove_repeats(spark.createDataFrame(data, "doc_id long, text string"), scratch, window, seed_words).drop("text", "passages").collect()
        assert sorted(map(tuple, found), key=str) == brute_repeats(data, window)


def test_passages_are_maximal(spark, scratch):
    shared = " ".join(f"s{i}" for i in range(60))
    data = [(1, f"a b {shared} c"), (2, f"d {shared} e {shared} f g"), (3, "short")]
    out = {r.doc_id: r for r in repeats.remove_repeats(spark.createDataFrame(data, "doc_id long, text string"), scratch).collect()}
    assert [tuple(p) for p in out[2].passages] == [(1, 60), (62, 60)] and out[2].text == "d e f g"
    assert out[1].passages is None and out[3].passages is None


def test_repeats_of_nothing(empty, scratch):
    assert repeats.remove_repeats(empty, scratch).count() == 0


# 3

def test_mixing(docs):
    out = mixing.mix_sources(docs, keep=("doc_id", "source")).collect()
    sizes = defaultdict(int)
    for r in docs.collect():
        sizes[r.source] += len(words(r.text))
    names = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, free = {}, set(names)
    while True:
        share = (sum(sizes.values()) - sum(3 * sizes[s] for s in names if s not in free)) / sum(weight[s] for s in free)
        above = {s for s in free if share * weight[s] > 3 * sizes[s]}
        if not above:
            break
        free -= above
    for s in names:
        target[s] = share * weight[s] if s in free else 3 * sizes[s]
    taken = defaultdict(int)
    for r in out:
        taken[r.source] += r.taken
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
        assert 0 <= r.taken <= 3 * r.size
    assert len(out) == docs.count()
    for s in names:
        assert abs(taken[s] - target[s]) <= 1
    assert sorted(map(str, out)) == sorted(map(str, mixing.mix_sources(docs, keep=("doc_id", "source")).collect()))


def test_mixed_documents_hold_the_words_taken(docs):
    taken = sum(r.taken for r in mixing.mix_sources(docs).collect())
    made = mixing.mixed_documents(docs, ("doc_id", "text", "source"))
    assert sum(len(words(r.text)) for r in made.collect()) == taken


def test_mixing_nothing(empty):
    assert mixing.mix_sources(empty).count() == 0
    assert mixing.mix_sources(empty.unionByName(empty.sparkSession.createDataFrame([(1, None, None, None, None, None, None)], empty.schema))).collect()[0].taken == 0


# 4

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
PARTS = ["a@b.c_d@e.f", "a@b.c..d@e.f ", "x@y.z@w.q", "+1 (415) 555-0123 ", "4111 1111 1111 1111", "4111-1111-1111-1112", "192.168.0.1.5", "999.1.2.3", "000255.1.2.3", " é😀 ", "+33 1 23 45 67 89", "a.b+c%d@e-f.co.uk", "@@", "..", "1..2.3.4.5", "12 34 56 78 90 12 34", "5500000000000004", "DE89370400440532013000 ", "SSN 123-45-6789 ", " 123-45-6789 "]


def luhn(d: str) -> bool:
    return sum((int(c) * 2 - 9 * (int(c) > 4)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0


def base_spans(t: str) -> str:
    out = []
    for order, (kind, p) in enumerate(BASE.items()):
        for m in re.finditer(p, t):
            d = re.sub("[^0-9]", "", m.group())
            ok = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")), "card": 14 <= len(d) <= 19 and luhn(d), "phone": 10 <= len(d) <= 15}[kind]
            if ok:
                out.append((m.start(), order, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(x[2] for x in sorted(out))


def test_private_data(spark, docs):
    rng = random.Random(7)
    data = rows(docs) + [(1000 + i, "".join(rng.choice(PARTS) for _ in range(rng.randint(1, 12)))) for i in range(400)] + [(5000, "1.2.3.4 " * 3000)]
    found = pii.find_private_data(spark.createDataFrame([(d, t, "clash") for d, t in data], "doc_id long, text string, pii_spans string"))
    base = F.filter("pii_spans", lambda s: s["kind"].isin(*pii.BASE_KINDS))
    for r in found.select("doc_id", "text", pii.spans_text(base).alias("b")).collect():
        # 300,000 equal letters: the plain pattern takes quadratic time there, and finds nothing without an @, a digit or a +
        assert r.b == ("" if r.doc_id == 407 else base_spans(r.text or "")), r.doc_id


def test_private_data_adds_checked_spans(spark):
    t = "iban GB82 WEST 1234 5698 7654 32 and GB82 WEST 1234 5698 7654 33, ssn 123-45-6789, part 123-45-6789"
    r = pii.find_private_data(spark.createDataFrame([(1, t)], "doc_id long, text string")).select(pii.spans_text(F.col("pii_spans")).alias("s"), pii.redacted(F.col("text"), F.col("pii_spans")).alias("t")).collect()[0]
    assert r.s == "iban:5:32,ssn:70:81,ssn:88:99"
    assert r.t.startswith("iban [IBAN] and GB82")


def test_redaction_of_many_spans(spark):
    """Spans at and across the borders of the pieces that a text is read in, and overlapping kinds."""
    for text, want in ((" é 1.2.3.4" * 3000, " é [IP]" * 3000), ("é" * 2040 + " 10.20.30.40 " + "x" * 5000 + " a@b.cd", "é" * 2040 + " [IP] " + "x" * 5000 + " [EMAIL]"), ("1.2.3.4@x.yz 1", "[EMAIL] 1"), ("", ""), ("1.2.3.4", "[IP]")):
        found = pii.find_private_data(spark.createDataFrame([(1, text)], "doc_id long, text string")).cache()
        made = found.select(pii.redacted(F.col("text"), F.col("pii_spans")).alias("t"), pii.spans_text(F.col("pii_spans")).alias("s")).collect()[0]
        assert made.t == want


def test_private_data_of_nothing(empty):
    assert pii.find_private_data(empty).count() == 0


# 5

def brute_statistics(text):
    w = words(text)
    lines = [x for x in (text or "").encode().split(b"\n") if words(x.decode())]
    covered = [False] * len(w)
    seen = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    for i in range(len(w) - 2):
        if seen[tuple(w[i : i + 3])] > 1:
            covered[i : i + 3] = [True] * 3
    return len(w), sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), sum(covered)


def test_statistics(spark, docs):
    more = [(900 + i, t) for i, t in enumerate(["a\na\n\nb\na \n \n", "x y z x y z x", "#<>|| && ab*\n#\n#", "\n", "a b c"])]
    data = docs.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    found = [tuple(r)[:6] for r in quality.document_statistics(data).collect()]
    assert sorted(found, key=str) == sorted(((d, *brute_statistics(t)) for d, t in rows(data)), key=str)


def test_rules_learn_a_conjunction():
    rng = np.random.default_rng(1)
    x = {"a": rng.random(3000), "b": rng.random(3000), "c": rng.random(3000)}
    low = (x["a"] > 0.7) & (x["b"] < 0.4)
    rules = quality.learn_rules(x, low)
    hit = np.any([r.covers(x) for r in rules], axis=0)
    assert (hit == low).mean() > 0.98
    assert quality.learn_rules(x, np.zeros(3000, bool)) == []


def test_quality_without_labels(spark, docs, empty, scratch):
    none = spark.createDataFrame([(None, 1), (5, None)], "doc_id long, quality int")
    judged, rules = quality.judge_quality(docs, none, scratch)
    assert rules == [] and judged.filter("kept and base_failed").count() == 0 and judged.count() == docs.count()


def test_rules_try_every_threshold():
    """The best of 3,000 thresholds lies between two that an even grid of a few hundred holds."""
    v = np.arange(3000) / 3000
    low = (v >= 1001.5 / 3000) & (v < 1004.5 / 3000)
    rules = quality.learn_rules({"a": np.repeat(v, 12)}, np.repeat(low, 12))
    hit = np.any([r.covers({"a": v}) for r in rules], axis=0)
    assert (hit == low).all()


def test_more_rules_than_a_dozen():
    x = {"a": np.repeat(np.arange(40), 30).astype(float)}
    low = x["a"] % 2 == 1
    assert len(quality.learn_rules(x, low)) == 20


def test_verdicts_follow_the_rules_row_by_row(spark, docs, scratch):
    many = [(1000 + i, " ".join(f"u{i}x{j}" + "#" * (i % 3 == 0) for j in range(60 + i % 9)) + ("\n# % #" * (i % 5))) for i in range(300)]
    data = docs.select("doc_id", "text").unionByName(spark.createDataFrame(many, "doc_id long, text string"))
    labels = spark.createDataFrame([(d, int("#" not in t)) for d, t in many] + [(1, None), (None, 1)], "doc_id long, quality int")
    judged, rules = quality.judge_quality(data, labels, scratch)
    assert rules
    over = lambda a, b: a / b if b else 0.0
    for r in judged.collect():
        x = {"n_words": float(r.n_words), "mean_word": over(r.word_chars, r.n_words), "symbols": over(r.n_symbols, r.word_chars), "dup_lines": over(r.n_dup_lines, r.n_lines), "repeat_words": over(r.n_repeat_words, r.n_words), "upper": over(r.n_upper, r.word_chars),
             "digits": over(r.n_digits, r.word_chars), "punct": over(r.n_punct, r.n_words), "distinct": over(r.n_distinct_words, r.n_words), "long_words": over(r.n_long_words, r.n_words), "unspaced": over(r.n_unspaced, r.n_words), "line_words": over(r.n_words, r.n_lines)}
        failed = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        bad = any(all(x[n] >= t if least else x[n] < t for n, least, t in rule.terms) for rule in rules)
        assert (r.base_failed, r.kept) == (failed, not failed and not bad)


def test_quality_of_nothing(spark, empty, scratch):
    judged, rules = quality.judge_quality(empty, spark.createDataFrame([(1, 0)], "doc_id long, quality int"), scratch)
    assert rules == [] and judged.count() == 0


# 6

def chat_rows(spark, data):
    return spark.createDataFrame(data, "conv_id long, turn long, role string, text string, mid string")


def call(*calls, content=None):
    return json.dumps({"content": content, "tool_calls": [{"id": i, "name": n, "arguments": a} for i, n, a in calls]})


def result(i, content="r"):
    return json.dumps({"tool_call_id": i, "content": content})


def test_chat(spark, scratch):
    schemas = chat.tool_schemas(spark, {"search": {"query": ("string", True), "limit": ("integer", False)}, "sum": {"values": ("array", True)}})
    data = [
        (1, 0, "user", 'say "hi" é\n', "x"), (1, 1, "assistant", call(("a", "search", {"limit": 1.5, "query": "q", "zz": {"b": 1, "a": [1, None]}}), ("b", "sum", {"values": {"$result": "c"}})), "x"),
        (1, 2, "tool", result("a"), "x"), (1, 3, "tool", result("a", "again"), "x"), (1, 4, "assistant", call(("c", "nope", {})), "x"), (1, 5, "tool", result("c"), "x"), (1, 6, "tool", result("gone"), "x"),
        (2, 5, "tool", result("k"), "x"), (2, 9, "assistant", call(("k", "search", {})), "x"), (2, 5, "tool", result("k"), "x"), (3, 0, "assistant", "{broken", "x"), (None, None, None, None, "x"), (4, 0, "user", "", "x"),
    ]
    out = chat.format_chat(chat_rows(spark, data), schemas, scratch).collect()
    by = {(r.conv_id, r.turn): r for r in out}
    assert len(out) == len(data)
    assert by[1, 0].message_json == '{"content":"say \\"hi\\" é\\n","role":"user"}'
    first = json.loads(by[1, 1].message_json)["tool_calls"]
    assert list(first[0]) == ["arguments", "id", "name"] and list(first[0]["arguments"]) == ["limit", "query", "zz"] and list(first[0]["arguments"]["zz"]) == ["a", "b"]
    assert by[1, 1].problems == ["a:type:limit", "a:unknown:zz"] and by[1, 1].n_calls == 2 and by[1, 1].n_linked == 1
    # b names the result of c, so its message stands behind turn 5, and so does the result of a behind it.
    assert by[1, 1]["at"] == 5 and by[1, 1].depth == 1 and (by[1, 2]["at"], by[1, 2].depth) == (5, 2)
    assert by[1, 4].problems == ["c:tool"] and by[1, 6].orphan and by[1, 3].orphan and not by[1, 2].orphan
    assert by[2, 5]["at"] == 9 and by[2, 9].problems == ["k:missing:query"]
    assert by[3, 0].message_json == '{"content":"{broken","role":"assistant"}' and by[None, None].message_json == "{}"


def test_chat_calls_without_id(spark, scratch):
    schemas = chat.tool_schemas(spark, {"search": {"query": ("string", True)}})
    data = [
        (1, 0, "assistant", json.dumps({"content": "hi", "tool_calls": [{"id": "a", "name": "search", "arguments": {"query": "q"}}, {"name": "search", "arguments": {"limit": 1}}, None]}), "x"),
        (1, 1, "tool", result("a"), "x"), (2, 0, "assistant", call((None, "search", {"query": "q"})), "x"),
        (3, 0, "assistant", call((None, "search", {"query": {"$result": "b"}}), ("b", "search", {"query": "q"})), "x"), (3, 1, "tool", result("b"), "x"),
    ]
    by = {(r.conv_id, r.turn): r for r in chat.format_chat(chat_rows(spark, data), schemas, scratch).collect()}
    told = json.loads(by[1, 0].message_json)
    assert told["content"] == "hi" and [c.get("id") for c in told["tool_calls"]] == ["a", None, None] and told["tool_calls"][1]["arguments"] == {"limit": 1}
    assert by[1, 0].n_calls == 3 and by[1, 0].n_linked == 1
    assert by[1, 0].problems == ["missing:id", "missing:id", "missing:query", "tool", "unknown:limit"]
    assert by[2, 0].problems == ["missing:id"] and by[2, 0].n_calls == 1
    assert by[3, 0].problems == ["missing:id"] and by[3, 0].n_linked == 1


def test_chat_cycle_ends(spark, scratch):
    data = [(1, 0, "assistant", call(("a", "t", {"x": {"$result": "b"}})), "x"), (1, 1, "tool", result("a"), "x"), (1, 2, "assistant", call(("b", "t", {"x": {"$result": "a"}})), "x"), (1, 3, "tool", result("b"), "x")]
    out = chat.format_chat(chat_rows(spark, data), chat.tool_schemas(spark, {"t": {"x": ("string", True)}}), scratch).collect()
    assert sorted(r["at"] for r in out) == [0, 1, 2, 3]


def test_chat_of_a_long_chain_and_long_texts(spark, scratch, monkeypatch):
    """Each call names the result of the next one, so all stand behind the last; more waves than are kept apart."""
    monkeypatch.setattr(chat, "WAVES", 3)
    n, long = 5, "é{" * 150_000
    data = [(1, 2 * i, "assistant", call((f"c{i}", "t", {"x": {"$result": f"c{i + 1}"} if i + 1 < n else long}), content=long if i == 0 else None), "x") for i in range(n)]
    data += [(1, 2 * i + 1, "tool", result(f"c{i}", long if i == 1 else "r"), "x") for i in range(n)] + [(1, 99, "user", long, "x")]
    # The same messages in another conversation, where the chain is broken: messages are named inside their conversation.
    data += [(2, t, role, text, m) for c, t, role, text, m in data if c == 1 and t != 2 * n - 1]
    out = chat.format_chat(chat_rows(spark, data), chat.tool_schemas(spark, {"t": {"x": ("string", True)}}), scratch).collect()
    assert len(out) == len(data)
    last = 2 * (n - 1)
    one = {r.turn: (r["at"], r.depth) for r in out if r.conv_id == 1}
    assert one[last] == (last, 0) and one[last + 1] == (last + 1, 0) and one[99] == (99, 0)
    for i in range(n - 1):
        assert one[2 * i] == (last + 1, 2 * (n - 1 - i) - 1) and one[2 * i + 1] == (last + 1, 2 * (n - 1 - i))
    two = {r.turn: r["at"] for r in out if r.conv_id == 2}
    assert two[last] == last and two[last - 2] == last - 2 and two[0] == last - 1
    assert json.loads(next(r.message_json for r in out if r.conv_id == 1 and r.turn == 0))["content"] == long


def test_chat_of_nothing(spark, scratch):
    assert chat.format_chat(chat_rows(spark, []), chat.tool_schemas(spark, {"t": {"x": ("string", True)}}), scratch).count() == 0


# 7

def brute_pieces(word: bytes, initial, rest):
    at, n = 0, 0
    while at < len(word):
        vocab = initial if at == 0 else rest
        for end in range(min(len(word), at + 64), at, -1):
            if word[at:end] in vocab:
                at, n = end, n + 1
                break
        else:
            return None
    return n


def test_longest_match_counts():
    rng = random.Random(3)
    for _ in range(60):
        pieces = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 5))).encode() for _ in range(rng.randint(1, 25))]
        cut = rng.randint(0, len(pieces))
        initial, rest = pieces[:cut], pieces[cut:] + ([b"a", b"b"] if rng.random() < 0.5 else [])
        counter = wordpiece.LongestMatchCounter(initial, rest)
        for _ in range(200):
            w = "".join(rng.choice("abc") for _ in range(rng.randint(0, 14))).encode()
            assert counter.count(w) == brute_pieces(w, set(initial), set(rest)), (w, initial, rest)


def test_token_counts(docs):
    path = tokenizer_file("piece_bpe_32k.model")
    initial, rest = (set(x) for x in wordpiece.read_vocabulary(path))
    assert max(map(len, initial | rest)) <= 64
    want = []
    for d, t in rows(docs):
        n = [brute_pieces(w, initial, rest) for w in words(t)]
        want.append((d, len(n), sum(1 if x is None else x for x in n), sum(x is None for x in n)))
    got = [tuple(r) for r in wordpiece.token_counts(docs, path).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_token_counts_of_nothing(empty):
    assert wordpiece.token_counts(empty, tokenizer_file("piece_bpe_32k.model")).count() == 0


def test_token_counts_with_bare_mark(spark):
    import sentencepiece

    path = tokenizer_file("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = {model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))}

    def greedy(word: str):
        marked, at, n = "▁" + word, 0, 0
        while at < len(marked):
            end = next((e for e in range(len(marked), at, -1) if marked[at:e] in pieces), None)
            if end is None:
                return None
            at, n = end, n + 1
        return n

    texts = ["ñta ça être ßen hello", "日本語 テキスト 😀", "\U0001f9ff hello ñ", "ñ" * 300, "plain words only", "", None]
    want = []
    for i, t in enumerate(texts):
        n = [greedy(w) for w in (t or "").split()]
        want.append((i, len(n), sum(1 if x is None else x for x in n), sum(x is None for x in n)))
    assert greedy("ñta") == 3
    got = wordpiece.token_counts(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), path, bare_mark=True)
    assert sorted(tuple(r) for r in got.collect()) == want


def test_query_counts_the_bare_mark(spark, tmp_path):
    from timeloom.llm import queries

    spark.createDataFrame([(1, "ñta")], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    assert [tuple(r) for r in queries.op7_token_counts(spark, str(tmp_path)).collect()] == [(1, 1, 3, 0)]


# 8

def test_toxicity_learns_held_out_texts(spark, scratch):
    rng = random.Random(4)
    bad, data = ["grobian", "wicht", "lump"], []
    for i in range(900):
        w = [rng.choice(["stone", "river", "cloud", "apple", "green", "house"]) for _ in range(rng.randint(5, 60))]
        if toxic := i % 4 == 0:
            w.insert(rng.randrange(len(w)), rng.choice(bad))
        data.append((i, " ".join(w), int(toxic)))
    data += [(2000, None, None), (2001, "", None), (None, "grobian", 1)]
    table = spark.createDataFrame(data, "doc_id long, text string, toxic int")
    out = toxicity.classify_toxicity(table.withColumn("score", F.lit("clash")), table, scratch).collect()
    held = [(r.score, r.predicted, data[r.doc_id][2]) for r in out if r.doc_id is not None and r.doc_id < 900 and zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert len(held) > 200 and sum(p == y for _, p, y in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in out) and len(out) == len(data)


def plain_grams(text):
    t = " " + re.sub("[\t-\r]", " ", (text or "").lower()) + " "
    return {t[i : i + k] for k in toxicity.SIZES for i in range(len(t) - k + 1)}


def test_toxicity_equals_a_plain_version(spark, scratch):
    """Features as strings, counts in dictionaries, the logistic regression by Newton's method."""
    rng = random.Random(11)
    names = ["stone", "river", "Cloud", "apple\t", "grün", "house", "lump", "wicht"]
    data = []
    for i in range(400):
        w = [rng.choice(names[:6]) for _ in range(rng.randint(1, 25))]
        if toxic := rng.random() < 0.3:
            w += [rng.choice(names[6:])] * (rng.random() < 0.8)
        data.append((i, " ".join(w), int(toxic)))
    data += [(500, "", 0), (501, None, 1), (502, "x" * 300_000, 0), (503, "lump " * 60_000, 1)]
    train = [(plain_grams(t), y) for i, t, y in data if zlib.crc32(str(i).encode()) % 3 != 1]
    bad, good = sum(y for _, y in train), sum(1 - y for _, y in train)
    seen = {0: Counter(g for gs, y in train if not y for g in gs), 1: Counter(g for gs, y in train if y for g in gs)}

    def apart(g):
        p, q = seen[1][g] / bad, seen[0][g] / good
        return abs(p - q) / math.sqrt((p * (1 - p) + 1 / bad) / bad + (q * (1 - q) + 1 / good) / good)

    kept = sorted(g for g in set(seen[0]) | set(seen[1]) if seen[0][g] + seen[1][g] >= toxicity.LEAST_TEXTS and apart(g) > toxicity.least_spread(len(train)))
    ratio = np.array([math.log((seen[1][g] + 1) / (bad + 2)) - math.log((seen[0][g] + 1) / (good + 2)) for g in kept])
    x = lambda gs: np.array([g in gs for g in kept]) * ratio
    m, y = np.column_stack([np.ones(len(train)), [x(gs) for gs, _ in train]]), np.array([y for _, y in train], float)
    b, ridge = np.zeros(len(kept) + 1), np.diag([0.0] + [2.0] * len(kept))
    for _ in range(40):
        p = 1 / (1 + np.exp(-m @ b))
        b += np.linalg.solve((m * (p * (1 - p))[:, None]).T @ m + ridge, m.T @ (y - p) - ridge @ b)
    table = spark.createDataFrame(data, "doc_id long, text string, toxic int")
    model = toxicity.train(toxicity.training_rows(table, table), scratch)
    assert len(model.grams) == len(kept) > 20
    for r in toxicity.classify_toxicity(table, table, scratch).collect():
        want = 1 / (1 + math.exp(-(b[0] + x(plain_grams(data[[d for d, _, _ in data].index(r.doc_id)][1])) @ b[1:])))
        assert abs(r.score - want) < 0.01 and (abs(want - 0.7) < 0.01 or r.predicted == (want >= 0.7))


def test_toxicity_without_labels(spark, docs, empty, scratch):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.classify_toxicity(docs, none, scratch).select("score").distinct().count() == 1
    assert toxicity.classify_toxicity(empty, none, scratch).count() == 0


# 9

def brute_links(data, cosine):
    n, reach = {}, {}
    for i, (a, u, lu) in enumerate(data):
        near = []
        for j, (b, v, lv) in enumerate(data):
            if i != j and good(u) and good(v) and len(u) == len(v) and lu == lv and lu is not None and a is not None and b is not None:
                x, y = np.array(u, np.float32).astype(float), np.array(v, np.float32).astype(float)
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= cosine:
                    near.append(j)
        n[i], reach[i] = len(near), near
    out = []
    for i, (a, _, _) in enumerate(data):
        seen, todo = {i}, [i]
        while todo:
            for j in reach[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        least = min((data[j][0] for j in seen if data[j][0] is not None), default=None)
        out.append((a, n[i], least))
    return sorted(out, key=str)


def good(v):
    return v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)


def test_vectors(spark, scratch):
    rng = np.random.default_rng(6)
    centers = rng.standard_normal((12, 16))
    data = [(i, [float(np.float32(x)) for x in centers[i % 12] + 0.04 * rng.standard_normal(16)], int(i % 12 % 3)) for i in range(240)]
    data += [(500, data[0][1], 0), (501, data[0][1], 0), (502, data[0][1], None), (503, None, 0), (504, [0.0] * 16, 0), (505, [1.0, None] * 8, 0), (506, [float("nan")] * 16, 0), (507, [], 0), (508, [1.0, 2.0], 0), (509, [2.0, 4.0], 0), (None, data[0][1], 0), (510, [2 * x for x in data[0][1]], 0), (511, [float("inf")] * 16, 1)]
    table = spark.createDataFrame([(*r, 1) for r in data], "vec_id long, embedding array<float>, label int, n_links int")
    out = [(r.vec_id, r.n_links, r.component_id) for r in vectors.link_vectors(table, scratch).collect()]
    assert sorted(out, key=str) == brute_links(data, 0.98)


def test_vectors_near_the_threshold(spark, scratch):
    """Recall over pairs just above 0.98 and none of those just below, in several labels; the bound of missed pairs is 1e-4."""
    rng = np.random.default_rng(10)
    data, wanted = [], 0
    for i in range(700):
        u = rng.standard_normal(64)
        u /= np.linalg.norm(u)
        v = rng.standard_normal(64)
        v -= (v @ u) * u
        v /= np.linalg.norm(v)
        cosine = rng.uniform(0.978, 0.984)
        data += [(2 * i, [float(np.float32(t)) for t in u], i % 4), (2 * i + 1, [float(np.float32(t)) for t in 3 * (cosine * u + math.sqrt(1 - cosine**2) * v)], i % 4)]
    out = {r.vec_id: r for r in vectors.link_vectors(spark.createDataFrame(data, "vec_id long, embedding array<float>, label int"), scratch).collect()}
    for i in range(700):
        u, v = (np.array(data[2 * i + k][1]) for k in (0, 1))
        linked = u @ v / np.sqrt((u @ u) * (v @ v)) >= 0.98
        wanted += linked
        if not linked:
            assert out[2 * i].n_links == out[2 * i + 1].n_links == 0
    found = sum(out[2 * i].n_links == out[2 * i + 1].n_links == 1 and out[2 * i + 1].component_id == 2 * i for i in range(700))
    assert 400 < wanted and found == wanted


def test_vectors_in_blocks(spark, scratch, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 7)
    rng = np.random.default_rng(8)
    one = rng.standard_normal(8)
    data = [(i, [float(np.float32(x)) for x in one + 0.03 * rng.standard_normal(8)], 1) for i in range(60)]
    out = [(r.vec_id, r.n_links, r.component_id) for r in vectors.link_vectors(spark.createDataFrame(data, "vec_id long, embedding array<float>, label int"), scratch).collect()]
    assert sorted(out, key=str) == brute_links(data, 0.98)


def test_vectors_of_nothing(spark, scratch):
    assert vectors.link_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int"), scratch).count() == 0


def test_components_of_chains(spark, scratch):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 200), (200, 150), (300, 300)] + [(1000, 1000 + i) for i in range(1, 50)]
    rng.shuffle(edges)
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(edges, "a long, b long"), scratch).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, 150: 100, 200: 100, **{1000 + i: 1000 for i in range(1, 50)}}


# 10

def shingles(text):
    w = [x.lower() if x.isascii() else bytes(c + 32 if 65 <= c <= 90 else c for c in x) for x in words(text)]
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)]) if w else frozenset()


def brute_jaccard(data):
    sets = [(d, shingles(t)) for d, t in data]
    parent = {d: d for d, _ in sets if d is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if a is not None and b is not None and s and t and 100 * len(s & t) >= 80 * len(s | t):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return sorted(((d, len(s), find(d) if d is not None else None) for d, s in sets), key=str)


def test_jaccard(docs, scratch):
    assert sorted(map(tuple, jaccard.jaccard_components(docs, scratch).collect()), key=str) == brute_jaccard(rows(docs))


def test_jaccard_of_large_groups(spark, scratch, monkeypatch):
    monkeypatch.setattr(jaccard, "PART", 6)
    rng = random.Random(9)
    base, data = [f"w{rng.randrange(400)}" for _ in range(120)], []
    for i in range(90):  # a cloud of near copies, some of them linked through others only
        w = list(base)
        for _ in range(rng.randrange(5)):
            w[rng.randrange(len(w))] = f"z{rng.randrange(1000)}"
        data.append((i, " ".join(w)))
    data += [(200 + i, " ".join(base[:40] + [f"u{i}_{j}" for j in range(60)])) for i in range(40)]  # a passage in common
    got = jaccard.jaccard_components(spark.createDataFrame(data, "doc_id long, text string"), scratch).collect()
    assert sorted(map(tuple, got), key=str) == brute_jaccard(data)


def test_jaccard_of_nothing(empty, scratch):
    assert jaccard.jaccard_components(empty, scratch).count() == 0


def test_tree_finds_all_pairs():
    rng = np.random.default_rng(11)
    sets = [np.unique(rng.integers(0, 2**63, n, dtype=np.uint64)) for n in rng.integers(3, 60, 60)]
    sets += [np.unique(np.concatenate((s[: int(len(s) * 0.95)], s[:0]))) for s in sets[:30]]
    maps = np.zeros((len(sets), 1024), bool)
    for i, s in enumerate(sets):
        maps[i, (s & np.uint64(1023)).astype(int)] = True
    packed = np.frombuffer(np.packbits(maps, axis=1).tobytes(), np.uint64).reshape(len(sets), -1)
    links = {(i, j) for j in range(len(sets)) for i in range(j) if jaccard.similar(sets[i], sets[j], 80)}
    for n_blocks in (1, 2, 30, 90):  # blocks of 90, 45, 3 and 1
        blocks = np.arange(len(sets)) % n_blocks
        a, b = jaccard.SignatureForest(blocks, np.array([len(s) for s in sets]), packed, np.arange(len(sets))).pairs(80)
        found = {(min(i, j), max(i, j)) for i, j in zip(a.tolist(), b.tolist())}
        wanted = {(i, j) for i, j in links if blocks[i] == blocks[j]}
        assert all(blocks[i] == blocks[j] for i, j in found) and wanted <= found and len(found) < len(wanted) + 60 and len(found) == len(a)
        assert bool(wanted) == (n_blocks < 90)


# shared kernels

def test_words_of_any_blocks():
    import pyarrow as pa

    texts = ["a bc  d\n", None, "", "é" * 50 + " x " * 40, "   ", "q" * 100, "\t1 2\x0b3\x0c4\r5", "a bc  d\n"]
    for size in (3, 10, 1 << 20):
        got, marks = [], []
        for b in textops.word_blocks(pa.array(texts), size):
            for i in range(b.n_rows):
                got.append(int(b.bounds[i + 1] - b.bounds[i]))
                marks.append(b.hashes[b.bounds[i] : b.bounds[i + 1]].tolist())
        assert got == [len(words(t)) for t in texts] and marks[0] == marks[-1]
        if size == 3:
            first = marks
        assert marks == first
