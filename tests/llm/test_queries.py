"""The registered queries against their SQL, and the pipeline against plain Python."""

from __future__ import annotations

import re
import sys
from pathlib import Path

import pytest
from compare import difference, open_tables
from test_pairs import linked
from test_rowwise import spans, statistics

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from mercato.llm import packing  # noqa: E402
from mercato.llm.queries import ORACLES, QUERIES  # noqa: E402
from mercato.llm.tables import stored  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(ORACLES))
def test_same_rows_as_sql(llm, name):
    assert difference(llm, open_tables(FOLDER), FOLDER, QUERIES[name], ORACLES[name]) is None


def test_every_operator():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))


@pytest.fixture(scope="module")
def texts(llm):
    return {r.doc_id: r.text for r in llm.read.parquet(f"{FOLDER}/documents.parquet").collect()}


def test_personal_data_digest(llm, texts):
    import hashlib

    kinds = ("email", "ip", "card", "phone")
    for r in QUERIES["op9_personal_data"](llm, FOLDER).collect():
        found = spans(texts[r.doc_id])
        written = ",".join(f"{kinds[k]}:{s}:{e}" for s, k, e in found)
        assert r.base_sha256 == hashlib.sha256(written.encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == i for _, k, _ in found) for i in range(4))
        assert set(filter(None, written.split(","))) <= set(r.spans.split(","))


def test_token_counts_are_the_library_s(llm, texts):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for r in QUERIES["op5_token_counts"](llm, FOLDER).collect():
        assert r.n_tokens == len(tokenizer.encode(texts[r.doc_id] or "", add_special_tokens=False)) and r.over_limit == (r.n_tokens > 1024)


def kept_by_rules(text):
    n, chars, symbols, duplicates, repeats = statistics(text)
    lines = len([x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)])
    if n < 50 or 100 * repeats > 50 * n or 10 * symbols > n or chars > 12 * n or chars < 2 * n or 2 * duplicates > lines:
        return False
    return 2 * len(re.findall("(?<![A-Za-z])[A-Z]{2}", text)) <= n and 3 * text.count("!") <= n


def test_pipeline_stage_by_stage(llm, texts):
    docs = llm.read.parquet(f"{FOLDER}/documents.parquet")
    columns, found = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(llm, docs, FOLDER), name)
        found[name] = docs.collect()
        assert name == "best_fit_packing" or docs.columns == columns
    good = {i for i, t in texts.items() if kept_by_rules(t)}
    assert {r.doc_id for r in found["quality_rules"]} == good
    one = {c for _, n, c in linked([(i, texts[i]) for i in sorted(good)])}
    assert {r.doc_id for r in found["near_duplicates"]} == one
    items = [" ".join(re.findall(r"[^\W_]+", r.text.lower())) for r in llm.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    plain = {i: " ".join(re.findall(r"[^\W_]+", texts[i].lower())) for i in one}
    clean = {i for i in one if not any(f" {item} " in f" {plain[i]} " for item in items)}
    assert {r.doc_id for r in found["decontamination"]} == clean
    hidden = {r.doc_id: r for r in found["personal_data"]}
    assert hidden.keys() == clean
    for i, r in hidden.items():
        assert r.n_chars == len(r.text) and (r.text == texts[i] or spans(texts[i]) or "<IDENTIFIER>" in r.text)
        assert all(texts[i][s:e] not in r.text for s, _, e in spans(texts[i]))
    sizes = {}
    for r in found["best_fit_packing"]:
        sizes[r.doc_id] = sizes.get(r.doc_id, 0) + r.n_tokens
        assert r.bin_used <= r.bin_length and r.bin_length in packing.LENGTHS
    assert sizes == {i: len(r.text.encode()) + 1 for i, r in hidden.items()}
