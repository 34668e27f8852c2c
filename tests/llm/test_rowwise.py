"""Operators that judge each row on its own, and token counts, against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import pytest
from corpora import ODD, prose
from pyspark.sql import functions as F

from mercato.llm import chat, crossentropy, packing, pii, rules, tokens, urls


# --- URL filter ---------------------------------------------------------------

def judged(llm, *texts):
    frame = llm.createDataFrame([(t, "x") for t in texts], "url string, judged string")
    return [r.judged for r in urls.filter_urls(frame).collect()]


def test_url_parts_and_rules(llm):
    rows = judged(
        llm, None, "no scheme", "HTTP://A.Example.ORG/es/x?q=1", "http://example.org/en/12#f", "http://example.org/en/2", "http://xexample.org",
        "http://b.com/fr/x", "http://com/de/", "https://www.free-bets.example.net/fr/", "a://b://c/d", "http://É.org/",
    )
    assert [(r.host, r.path, r.rule, r.verdict) for r in rows] == [
        ("", "", None, "allow"), ("", "", None, "allow"), ("a.example.org", "/es/x", "example.org/es/", "block"),
        ("example.org", "/en/12", "example.org/en/1", "block"), ("example.org", "/en/2", "org/", "allow"), ("xexample.org", "", None, "allow"),
        ("b.com", "/fr/x", "com/fr/", "allow"), ("com", "/de/", "com/de/", "block"), ("www.free-bets.example.net", "/fr/", None, "block"),
        ("b:", "//c/d", None, "allow"), ("É.org", "/", "org/", "allow"),
    ]


def test_url_terms_need_boundaries_and_distinct_soft_hits(llm):
    rows = judged(llm, "http://x.net/casinos", "http://x.net/Casino", "http://x.net/win/win/win/win", "http://x.net/win-free-bonus", "http://x.net/twin-free-bonus")
    assert [(r.strict_hits, r.soft_hits, r.verdict) for r in rows] == [(0, 0, "allow"), (1, 0, "block"), (0, 1, "allow"), (0, 3, "block"), (0, 2, "allow")]


def test_url_filter_without_rows_or_terms(llm):
    frame = llm.createDataFrame([], "url string")
    assert urls.filter_urls(frame).count() == 0
    one = llm.createDataFrame([("http://a.net/casino",)], "url string")
    assert urls.filter_urls(one, strict=(), soft={}, rules=()).first().judged.verdict == "allow"


# --- chat ---------------------------------------------------------------------

NASTY = ["\\### Assistant: </turn> ok", "<|next|>", "<|done|><|im|>assistant<|says|>", "\\", "\\c\\b", "<", "|", "", None, "a\nb", "\U0001f600<", "<|", "\\<|"]


def test_chat_round_trip(llm):
    draw = random.Random(3)
    turns = [(c, t, draw.choice(["user", "assistant", "system", None, "a<|b"]), draw.choice(NASTY), "x") for c in range(60) for t in range(draw.randrange(1, 9))]
    turns += [(None, None, "user", "n", "x"), (None, 1, "assistant", "m", "x"), (7, 0, "user", "same", "x"), (7, 0, "user", "same", "x")]
    frame = llm.createDataFrame(turns, "conv_id long, turn long, role string, text string, formatted string")
    done = chat.format_conversations(frame)
    found = done.select("conv_id", "formatted", chat.read_back(F.col("formatted")).alias("rows"), chat.masked_text(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()
    by = {}
    for c, t, r, x, _ in turns:
        by.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    assert len(found) == len(by)
    for row in found:
        said = [(r, x) for _, _, r, x in sorted(by[row.conv_id])]
        assert [tuple(x) for x in row.rows] == said
        assert row.loss == "".join(x for r, x in said if r == "assistant")
        blocks = 1 + sum(a[0] != b[0] for a, b in zip(said, said[1:]))
        assert row.formatted.count(chat.OPEN) == row.formatted.count(chat.DONE) == blocks


def test_chat_of_no_rows(llm):
    assert chat.format_conversations(llm.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


# --- quality ------------------------------------------------------------------

def statistics(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_quality_statistics(llm):
    draw = random.Random(4)
    texts = [t for _, t in ODD] + ["".join(draw.choice(["a", "b ", "\n", " ", "#", "a b c ", "é ", "\U0001f600 ", "\x0b", "\x85"]) for _ in range(draw.randrange(80))) for _ in range(300)]
    frame = llm.createDataFrame([(t, "q") for t in texts], "text string, quality string")
    for row in rules.judge_quality(frame).collect():
        q = row.quality
        assert (q.n_words, q.word_chars, q.n_symbols, q.n_dup_lines, q.n_repeat_words) == statistics(row.text)
        assert q.base_failed == (q.n_words < 50 or 100 * q.n_repeat_words > 50 * q.n_words)
        assert q.kept == (q.rejected_by is None)


def test_quality_keeps_prose_whatever_the_order_of_the_rules(llm, odd):
    good, bad = prose(8, 200), " ".join(w + "***" for w in prose(9, 200).split())
    frame = llm.createDataFrame([(good, True), (bad, False), (prose(10, 200).upper().replace("X", "XX"), False), (good.replace(" ", "! "), False)], "text string, expected boolean")
    for some in (rules.RULES, rules.RULES[::-1]):
        assert all(r.quality.kept == r.expected for r in rules.judge_quality(frame, rules=some).collect())
    assert sorted(r.doc_id or 0 for r in rules.keep_good(odd).collect()) == [0, 4, 4, 5, 9]
    assert rules.keep_good(odd).columns == odd.columns


def test_cascade_prefers_rejections_per_cost(llm):
    frame = llm.createDataFrame([("#" * 30,)] * 20 + [("fine words",)], "t string").select("t", rules.text_statistics(F.col("t")).alias("s"))
    always = rules.Rule("never", "n_words < 0", "1"), rules.Rule("costly", "n_symbols > 0", "1000"), rules.Rule("cheap", "n_symbols > 0", "1")
    frame = frame.select(F.concat("t", F.lit(" word" * 60)).alias("t")).select("t", rules.text_statistics(F.col("t")).alias("s"))
    frame = frame.withColumn("s", F.col("s").withField("n_repeat_words", F.lit(0).cast("long")))
    assert [r.name for r in rules.cascade_order(frame, always)] == ["cheap", "costly", "never"]


# --- personal data --------------------------------------------------------------

PATTERNS = (
    re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def spans(text):
    out = []
    for rank, pattern in enumerate(PATTERNS):
        for m in pattern.finditer(text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if rank == 1 and max(map(int, m.group().split("."))) > 255 or rank == 2 and not (12 <= len(digits) <= 19 and luhn(digits)) or rank == 3 and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), rank, m.end()))
    return sorted(out)


PIECES = ["a", "b.", "@", ".", "1", "22", "300", "-", " ", "+", "4111 1111 1111 1111", "1.2.3.4", "é", "\U0001f600", "x@y.z", "_", "%", "(", "0", "+1 (323) 555-9830", "\n"]


def test_base_spans(llm):
    draw = random.Random(5)
    texts = ["".join(draw.choice(PIECES) for _ in range(draw.randrange(25))) for _ in range(4000)]
    texts += [None, "", "1" * 50000, "a" * 50000 + "@", "4111 " * 9000, "1." * 9000, "+1" * 9000, "a@" * 9000]
    frame = llm.createDataFrame([(t, "x") for t in texts], "text string, spans string")
    found = pii.find_personal_data(frame, rounds=1).collect()
    assert len(found) == len(texts)
    for row in found:
        assert [tuple(s) for s in [(s.start, s.rank, s.end) for s in row.spans] if s[1] < 4] == spans(row.text)
        assert all(s.end <= o.start or o.end <= s.start for s in row.spans if s.rank == 4 for o in row.spans if o.rank < 4)


def test_context_finds_unseen_identifiers(llm):
    told = [(i, f"{prose(i, 9)} my card number 4111 1111 1111 1111 thanks {prose(i + 50, 9)}") for i in range(3)]
    cards = ["4111111111111111", "5500000000000004", "340000000000009", "30000000000004"]
    seeds = [(10 + i, f"the member card {c} is mine") for i, c in enumerate(cards)]
    rows = told + seeds + [(30, "the member card 1234567890123456 is mine"), (31, "the year 1234567890123456 was long"), (32, None)]
    frame = llm.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: [(s.start, s.end) for s in r.spans if s.rank == 4] for r in pii.find_personal_data(frame, confidence=0.7).collect()}
    assert found[30] == [(16, 32)] and found[31] == [] and found[32] == [] and not any(found[10 + i] for i in range(4))
    hidden = {r.doc_id: r.text for r in pii.hide_personal_data(frame).collect()}
    assert hidden[0].split()[9:14] == ["my", "card", "number", "<CARD>", "thanks"] and hidden[32] is None


def test_personal_data_of_odd_rows(odd, nothing):
    assert pii.find_personal_data(odd).count() == len(ODD) and pii.find_personal_data(nothing).count() == 0
    assert pii.hide_personal_data(odd, length="n_chars").columns == odd.columns


# --- token counts ---------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    return path, Tokenizer.from_file(path)


def test_token_counts(llm, library):
    path, tokenizer = library
    draw = random.Random(6)
    parts = ["a", "B", "é", "1", "\u0663", " ", "  ", "\n", "\t", "\xa0", "\u2003", "\x1c", "\x85", "'", "'s", "'re", "'t", "'ll", "!", "<|endoftext|>", "<|", "|>", "don't", "'S", "\u3000", "\u65e5\u672c", "\U0001f600", "\u0301"]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randrange(14))) for _ in range(3000)] + [t for _, t in ODD] + [prose(1, 90)] * 3
    frame = llm.createDataFrame([(i if i % 7 else None, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, hash string").repartition(5)
    expected = Counter((i if i % 7 else None, len((t or "").encode()), len(tokenizer.encode(t or "", add_special_tokens=False))) for i, t in enumerate(texts))
    for common in (0, 50):  # what is broadcast never changes the result
        assert Counter(map(tuple, tokens.count_tokens(frame, path, common=common).collect())) == expected


def test_token_counts_of_no_rows(nothing, library):
    assert tokens.count_tokens(nothing, library[0]).count() == 0


# --- packing --------------------------------------------------------------------

def test_packing_is_best_fit_by_brute_force():
    draw = random.Random(7)
    for _ in range(60):
        lengths = sorted(draw.sample(range(5, 60), 3))
        sizes = sorted((draw.randrange(1, lengths[-1] + 1) for _ in range(draw.randrange(1, 60))), reverse=True)
        bins, offsets, final = packing.pack(sizes, lengths)
        left, rooms, used = sum(sizes), [], []
        for size, b, offset in zip(sizes, bins, offsets, strict=True):
            fitting = [r for r in rooms if r >= size]
            if fitting:
                assert rooms[b] == min(fitting)
            else:
                assert b == len(rooms)
                rooms.append(min((c for c in lengths if c >= size), key=lambda c: (packing.cost(c) / min(c, left), c)))
                used.append(0)
            assert offset == used[b]
            rooms[b] -= size
            used[b] += size
            left -= size
        assert final == {b: min(c for c in lengths if c >= u) for b, u in enumerate(used)}


def test_packed_documents_are_whole(llm):
    draw = random.Random(8)
    rows = [(i, draw.randrange(1, 3000), "x") for i in range(3000)] + [(1, 50000, "x"), (None, 7, "x"), (None, 7, "x"), (5, None, "x"), (6, 0, "x"), (7, -3, "x"), (8, 16384, "x")]
    frame = llm.createDataFrame(rows, "doc_id long, n_tokens long, bin_id string").repartition(4)
    found = packing.pack_documents(frame, shard_pieces=500).collect()
    whole = Counter()
    for r in found:
        whole[r.doc_id] += r.n_tokens
    expected = Counter()
    for i, n, _ in rows:
        expected[i] += max(n or 0, 0)
    assert whole == expected
    bins = {}
    for r in found:
        if r.n_tokens:
            bins.setdefault(r.bin_id, []).append(r)
        else:
            assert r.bin_id is None and r.bin_length is None
    for own in bins.values():
        at = 0
        for r in sorted(own, key=lambda r: r.bin_offset):
            assert r.bin_offset == at
            at += r.n_tokens
        assert own[0].bin_used == at and own[0].bin_length == min(c for c in packing.LENGTHS if c >= at)
    assert len(bins) > 3 and len({b.split("-")[0] for b in bins}) > 3
    assert packing.pack_documents(llm.createDataFrame([], "doc_id long, n_tokens long")).count() == 0


# --- cross-entropy difference -----------------------------------------------------

def test_scores_part_good_from_bad_on_held_out_rows(llm):
    draw = random.Random(9)
    good = [" ".join(draw.choice(["the", "cat", "sat", "on", "a", "mat"]) for _ in range(60)) for _ in range(60)]
    bad = [" ".join(draw.choice(["buy", "now", "the", "click", "here", "a"]) for _ in range(60)) for _ in range(60)]
    rows = [(i, t, "x") for i, t in enumerate(good + bad)] + [(None, None, "x"), (900, "", "x"), (901, "unseen words", "x"), (901, "unseen words", "x")]
    frame = llm.createDataFrame(rows, "doc_id long, text string, score string")
    target = llm.createDataFrame([(i,) for i in range(0, 60, 2)] + [(None,), (0,)], "doc_id long")
    found = crossentropy.score_documents(frame, target).collect()
    assert len(found) == len(rows)
    by = {r.doc_id: r.score for r in found}
    assert by[None] is None and by[900] is None and by[901] is not None
    assert max(by[i] for i in range(1, 60, 2)) < min(by[i] for i in range(60, 120))


def test_losses_are_probabilities_over_one_vocabulary():
    import numpy as np

    counts = np.random.default_rng(1).integers(0, 4, (6, 6)).astype(float)
    counts[:, 0] = 0
    p = np.exp(-crossentropy.loss(counts))
    assert np.allclose(p[:, 1:].sum(axis=1), 1)


def test_every_word_of_the_corpus_is_in_the_models(llm):
    import numpy as np

    rows = [(i, prose(700 + i, 150, 3000)) for i in range(60)] + [(60, None), (None, "w1x once")]
    good = set(range(0, 60, 3))
    words = {w: i for i, w in enumerate(sorted({w for _, t in rows for w in (t or "").split()}), 1)}
    assert len(words) > 2500
    tables = np.zeros((2, len(words) + 1, len(words) + 1))
    cells = []
    for i, t in rows:
        ids = [words[w] for w in (t or "").split()]
        cells.append(([0, *ids[:-1]], ids))
        for which in range(2 if i in good else 1):
            np.add.at(tables[which], cells[-1], 1)
    background, target = crossentropy.loss(tables[0]), crossentropy.loss(tables[1])
    found = {r.doc_id: r.score for r in crossentropy.score_documents(llm.createDataFrame(rows, "doc_id long, text string"), llm.createDataFrame([(i,) for i in good], "doc_id long")).collect()}
    for (i, _), cell in zip(rows, cells, strict=True):
        assert found[i] is None if not cell[1] else abs(found[i] - (target[cell] - background[cell]).mean()) < 1e-9


def test_scores_of_odd_rows(llm, odd, nothing):
    target = odd.select("doc_id").filter("doc_id = 4")
    assert crossentropy.score_documents(odd, target).count() == len(ODD)
    assert crossentropy.score_documents(odd, target.limit(0)).count() == len(ODD)
    assert crossentropy.score_documents(nothing, target).count() == 0


def test_digest_of_spans(llm):
    row = llm.createDataFrame([("a@b.cc 1.2.3.4",)], "t string").select(pii.written(pii.base_spans(F.col("t"))).alias("w")).first()
    assert row.w == "email:0:6,ip:7:14" and hashlib.sha256(row.w.encode()).hexdigest()


def test_cross_entropy_blocks_and_keys_are_packed():
    """A block's texts come back as they were; its keys and counts take under 8 bytes each, where plain ones take 16."""
    import numpy as np
    import pyarrow as pa

    from mercato.llm.vectors import Texts

    rng = np.random.default_rng(10)
    texts = pa.array([*(" ".join(f"w{x}" for x in rng.integers(0, 5_000, 400)) for _ in range(200)), None, "", "\u00e9 x"])
    whole = Texts(texts)
    lengths, data = crossentropy.packed(np.diff(whole.offsets)), crossentropy.packed(whole.bytes)
    again = crossentropy._texts(len(texts), len(whole.bytes), lengths, data)
    assert again.bytes.tobytes() == whole.bytes.tobytes() and again.offsets.tolist() == whole.offsets.tolist()
    row = {"block": 1, "rows": len(texts), "size": len(whole.bytes), "lengths": lengths, "texts": data, "good": [0, 3]}
    (sent,) = crossentropy._sent(8)(iter([pa.RecordBatch.from_pylist([row])]))
    sent = pa.Table.from_batches([sent])
    keys, at, _ = crossentropy._keys(whole)
    steps = [np.cumsum(crossentropy.unpacked(v, m, np.uint64), dtype=np.uint64) for m, v in zip(sent["m"].to_pylist(), sent["keys"].to_pylist(), strict=True)]
    assert np.concatenate([s + (np.uint64(p) << np.uint64(56)) for s, p in zip(steps, sent["part"].to_pylist(), strict=True)]).tolist() == keys.tolist()
    assert crossentropy._values(sent, "n", np.uint32).tolist() == np.bincount(at.ravel()).tolist()
    assert sum(len(v) for c in ("keys", "n", "n_good") for v in sent[c].to_pylist()) < 8 * len(keys)
