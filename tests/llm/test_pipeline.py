import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import test_rules
import test_simhash
from tokenizers import Tokenizer

import corpus_pipeline
from shoploom.llm import gam, queries, rules

FOLDER = "/root/testdata/sf0.001"
PLAIN = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def keeps(r):
    """Quality rules, plainly."""
    words, chars, symbols, dup_lines, repeated = test_rules.plain(r.text)
    if words < 50 or 100 * repeated > 50 * words:
        return False
    lines = [x for x in r.text.split("\n") if test_rules.WORD.search(x)]
    stops = sum(w.lower() in rules.STOP_WORDS for w in test_rules.WORD.findall(r.text))
    bullets, cut = (sum(bool(re.search(p, x)) for x in lines) for p in (r"^\s*[-*•]", r"(\.\.\.|…)\s*$"))
    n = len(lines)
    return 2 <= chars / words <= 16 and symbols / words <= 0.1 and stops / words >= 0.02 and dup_lines / n <= 0.3 and bullets / n <= 0.9 and cut / n <= 0.3


def test_against_plain_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = docs.collect()
    model = queries.quality_model(spark, FOLDER, docs)
    kept = [r for r in rows if model.score(gam.features([r.text.encode()]))[0] >= 0.5]
    assert len(rows) > len(kept) > len(rows) / 2
    kept = [r for r in kept if keeps(r)]
    newest = {}
    for r in kept:
        newest[lower(r.text)] = max(newest.get(lower(r.text), -1), r.doc_id)
    kept = sorted((r for r in kept if newest[lower(r.text)] == r.doc_id), key=lambda r: r.doc_id)
    groups = test_simhash.plain_components([test_simhash.plain_fingerprint(r.text) for r in kept])
    expected = {r.doc_id: PLAIN.encode(r.text, add_special_tokens=False).ids + [0] for k, r in enumerate(kept) if groups[k] == k}

    found = corpus_pipeline.run(spark, FOLDER).collect()
    assert {r.doc_id for r in found} == expected.keys()
    bins = defaultdict(list)
    for r in found:
        part = expected[r.doc_id][r.start : r.start + r.length]
        assert len(part) == r.length and zlib.crc32(np.array(part, "<u4").tobytes()) == r.ids_crc32
        bins[r.sequence_id].append((r.offset, r.length))
    assert sum(r.length for r in found) == sum(map(len, expected.values()))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048


def test_stages_return_documents_columns_and_take_odd_rows(spark):
    text = " ".join(f"of the word{k}" for k in range(40))
    rows = [(None, text, None, None, None), (1, None, "en", "s", 0), (2, "", "en", "s", 0), (3, text, "en", "s", 1), (3, text, "en", "s", 1), (4, text.upper(), "en", "s", 1)]
    rows += [(5, "word " * 60_000, "en", "s", 1), (6, " ".join(f"that was of number{k}" for k in range(20_000)), "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for part in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, part, FOLDER)
            assert out.columns == docs.columns
            out.collect()
        assert (corpus_pipeline.STAGES[-1][1](spark, part, FOLDER).count() > 0) == (part is docs)
    assert sorted(str(r.doc_id) for r in corpus_pipeline.exact_dedup(spark, docs, FOLDER).collect()) == ["2", "4", "5", "6"]
