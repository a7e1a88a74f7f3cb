"""Packing, Re-Pair files and trie counts against plain use of the tokenizers."""

import random
import re
import unicodedata
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.models import Unigram

from rampart.functions.session import fresh_path
from rampart.llm import counts, packing, repair, stages
from rampart.llm.common import lean
from rampart.llm.encoding import Encoder, encoder
from rampart.llm.queries import QUERIES

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def plain_ids(path, text, end):
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def check_packing(docs, window):
    rows = packing.pack(docs, BYTES, end_id=1, window=window).collect()
    wanted = sorted((str(r.doc_id), plain_ids(BYTES, r.text, 1)) for r in docs.collect())
    rows.sort(key=lambda r: (r.sequence_id, r.offset))
    place, found, current = 0, [], None
    for row in rows:
        assert (row.sequence_id, row.offset) == divmod(place, window)
        ids = np.frombuffer(row.ids, "<u4").tolist()
        assert row.length == len(ids) > 0 and row.ids_crc32 == crc(ids)
        if row.start == 0:
            current = (str(row.doc_id), [])
            found.append(current)
        assert row.start == len(current[1]) and row.continued == (row.start > 0)
        current[1].extend(ids)
        assert row.continues == (len(current[1]) < row.doc_tokens)
        place += row.length
    assert sorted(found) == wanted


def test_packing_is_an_exact_round_trip(odd_docs):
    check_packing(odd_docs, 2048)
    check_packing(odd_docs.repartition(3), 100)


def test_documents_are_cut_without_python(odd_docs):
    """Workers that hold batches of whole documents and of their pieces took too much of an executor."""
    pieces = packing.pack(odd_docs, BYTES, end_id=1, window=100)
    plan = pieces._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Arrow|Pandas|Python", plan), plan
    assert pieces.where("start > 0 and length < 100").count() > 0
    for row in pieces.where("not continued").select("length", "doc_tokens", "offset", "continues", "ids").collect():
        assert row.length == min(row.doc_tokens, 100 - row.offset) and row.continues == (row.length < row.doc_tokens)
        assert len(row.ids) == 4 * row.length


def test_tasks_of_other_operators_clear_the_encoder():
    """A worker that has packed kept its encoder while it scored the documents of the next run."""
    encoder.cache_clear()
    encoder(BYTES, True, 100, 64)
    list(lean(lambda batches: batches, keeps=True)(iter([])))
    assert encoder.cache_info().currsize == 1
    list(lean(lambda batches: batches)(iter([])))
    assert encoder.cache_info().currsize == 0


def test_packing_of_nothing(no_docs):
    assert packing.pack(no_docs, BYTES, end_id=1).collect() == []


@pytest.mark.parametrize("block", [200, 5_000_000])
def test_repair_is_an_exact_round_trip(spark, odd_docs, block):
    path = fresh_path(spark, "repair-test")
    repair.write_repair(odd_docs, path, WORDS, end_id=2, vocabulary=49_408, shards=3, block_tokens=block)
    rows = sorted(repair.read_repair(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted((r.doc_id for r in rows), key=lambda x: (x is not None, x or 0))
    wanted = sorted((str(r.doc_id), plain_ids(WORDS, r.text, 2)) for r in odd_docs.collect())
    assert sorted((str(r.doc_id), np.frombuffer(r.ids, "<u4").tolist()) for r in rows) == wanted
    place = 0
    for row in rows:
        ids = np.frombuffer(row.ids, "<u4")
        assert (row.start, row.n_tokens, row.ids_crc32) == (place, len(ids), crc(ids))
        place += len(ids)
    # Random access: any part of any document of any block.
    by_place = {r.start: np.frombuffer(r.ids, "<u4") for r in rows}
    offset = 0
    for cell in sorted(spark.read.parquet(path).collect(), key=lambda r: (r.shard, r.block)):
        for number, size in enumerate(cell.doc_tokens):
            ids = by_place[offset]
            for start, stop in ((0, None), (size // 3, size // 2), (size - 1, size)):
                assert repair.document_ids(cell.asDict(), number, start, stop).tolist() == ids[start:stop].tolist()
            offset += size


def test_repair_of_nothing(spark, no_docs):
    path = fresh_path(spark, "repair-test")
    repair.write_repair(no_docs, path, WORDS, end_id=2, vocabulary=49_408)
    assert repair.read_repair(spark, path).collect() == []


def test_grammar_compresses_and_rules_are_whole():
    rng = np.random.default_rng(1)
    ids = np.tile(rng.integers(0, 50, 500), 40).astype(np.uint32)
    last = np.zeros(len(ids), bool)
    last[499::500] = True
    symbols, marks, rules = repair.compress(ids, last.copy(), 50)
    lengths = repair.rule_lengths(rules, 50)
    assert len(symbols) < len(ids) / 10 and marks.sum() == 40
    assert np.array_equal(repair.expand(symbols, rules, lengths, 50), ids)
    assert lengths.tolist() == [len(repair.expand(np.array([50 + i]), rules, lengths, 50)) for i in range(len(rules))]
    same = np.zeros(1001, np.uint32)
    symbols, _, rules = repair.compress(same, np.arange(1001) == 1000, 50)
    assert np.array_equal(repair.expand(symbols, rules, repair.rule_lengths(rules, 50), 50), same)


def test_trie_counts_equal_a_unigram_tokenizer(spark, odd_docs):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    trie = counts.counter(PIECES)
    plain = [i for i in range(model.vocab_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    scores = counts.zipf_scores([model.id_to_piece(i) for i in plain])
    low = min(scores.values())
    pieces = [("<unk>", low), *((f"<0x{i:02X}>", low - 1e6) for i in range(256)), *scores.items()]
    library = Tokenizer(Unigram(pieces, unk_id=0, byte_fallback=True))
    docs = odd_docs.select("doc_id", "text").union(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text"))
    found = counts.token_counts(docs, PIECES).collect()
    texts = docs.collect()
    assert len(found) == len(texts)
    wanted = []
    for row in texts:
        words = counts.re.findall(counts.WORD, row.text or "")
        if any(len(w) > 5_000 for w in words):
            words_tokens = int(trie.count([words])[0])
        else:
            words_tokens = sum(len(library.encode(counts.WORD_MARK + w).ids) for w in words)
        wanted.append((str(row.doc_id), len(words), words_tokens))
    assert sorted((str(r.doc_id), r.n_words, r.n_tokens) for r in found) == sorted(wanted)


def test_trie_counts_of_nothing(no_docs):
    assert counts.token_counts(no_docs, PIECES).collect() == []


def test_trie_shares_prefixes_of_any_words():
    scores = counts.zipf_scores(["▁", "a", "b", "ab", "ba", "▁ab", "aba"])
    trie = counts.TrieCounter(scores)

    def brute(word):
        best = {0: (0.0, 0)}
        for j in range(1, len(word) + 1):
            options = []
            for i in range(j):
                own = scores.get(word[i:j])
                if own is not None:
                    options.append((best[i][0] + own, best[i][1] + 1))
            if word[j - 1] not in scores:
                options.append((best[j - 1][0] + min(scores.values()) - 10, best[j - 1][1] + len(word[j - 1].encode())))
            best[j] = max(options, key=lambda x: x[0])
        return best[len(word)][1]

    words = ["ab", "aba", "abab", "b", "é", "abé", "ababab", "ba"]
    assert [int(trie.count([[w]])[0]) for w in words] == [brute("▁" + w) for w in words]
    assert trie.count([words, [], words[:2]]).tolist() == [sum(brute("▁" + w) for w in words), 0, brute("▁ab") + brute("▁aba")]


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_pieces_have_the_ids_of_whole_texts(path):
    tokens = Encoder(path)
    rng = random.Random(8)
    letters = [chr(c) for c in range(0x80, 0x20000) if chr(c).isalnum()]
    marked = [c for c in letters if not unicodedata.normalize("NFC", c).lower().isalnum()]
    assert "\u0130" in marked and "\u0958" in marked and "\ufb2a" in marked
    texts = ["HABERLER\u0130, YEN\u0130.", *(form.format(c) for c in letters for form in ("a{},b", "{}'s", "{0}1. {0}", "-{}a"))]
    some = ["\u0130", *marked, *rng.sample(letters, 40), *"aeis1 ,.'-_\n!\u0301\u0307"]
    texts += ["".join(rng.choices(some, k=rng.randrange(1, 12))) for _ in range(20_000)]
    ids, sizes = tokens.encode(texts, 2)
    wanted = tokens._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
    stops = np.cumsum(sizes)
    wrong = [t for t, a, b, x in zip(texts, stops - sizes, stops, wanted) if ids[a:b].tolist() != [*x.ids, 2]]
    assert wrong == []


def test_queries_know_added_tokens_as_the_library_does(spark, odd_docs, tmp_path):
    more = [(20, "a b <|endoftext|> c"), (21, "<|startoftext|><|endoftext|>"), (22, "<|ENDOFTEXT|> <|endoftext|"), (23, "x<|endoftext|>, YEN\u0130.")]
    docs = odd_docs.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string"))
    docs.select("doc_id", "text", *(F.lit(None).cast("string").alias(c) for c in ("lang", "source")), F.lit(1).alias("n_chars")).write.parquet(
        f"{tmp_path}/documents.parquet"
    )

    def wanted(path, end):
        tokenizer = Tokenizer.from_file(path)
        ids = [[*tokenizer.encode(r.text or "", add_special_tokens=False).ids, end] for r in docs.collect()]
        return sorted((str(r.doc_id), len(x), crc(x)) for r, x in zip(docs.collect(), ids))

    assert Tokenizer.from_file(WORDS).encode(more[0][1], add_special_tokens=False).ids == [320, 321, 49407, 322]
    rows = QUERIES["op1_repair"](spark, str(tmp_path)).collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in rows) == wanted(WORDS, 2)
    rows = [r for r in QUERIES["op8_packing"](spark, str(tmp_path)).collect() if r.length == r.doc_tokens]
    found = sorted((str(r.doc_id), r.doc_tokens, r.ids_crc32) for r in rows)
    assert set(found) <= set(wanted(BYTES, 1)) and {str(x) for x, _ in more} <= {x for x, *_ in found}
    stage = stages.packing_stage(spark, docs, str(tmp_path)).where("length = doc_tokens").collect()
    assert sorted((str(r.doc_id), r.doc_tokens, r.ids_crc32) for r in stage) == found


@pytest.mark.parametrize("path", [BYTES, WORDS])
@pytest.mark.parametrize("pieces, chars", [(60, 10**6), (10**6, 300), (10**6, 10**6)])
def test_pieces_equal_whole_texts_when_pieces_are_forgotten(monkeypatch, path, pieces, chars):
    monkeypatch.setattr("rampart.llm.encoding.MEMORY", pieces)
    monkeypatch.setattr("rampart.llm.encoding.MEMORY_CHARS", chars)
    generator, tokens, library = random.Random(11), Encoder(path, True), Tokenizer.from_file(path)
    signs = ["the", "IT'S", "x=1", "é", "İ", "×", "Σας", "漢字", "\u0301", "\u0338", "\t", "\xa0", "<|endoftext|>", *" \n.,'<>=_-a9"]
    for _ in range(30):
        texts = ["".join(generator.choices(signs, k=generator.randrange(12))) for _ in range(40)]
        ids, sizes = tokens.encode(texts, 1)
        wanted = [[*library.encode(text, add_special_tokens=False).ids, 1] for text in texts]
        assert sizes.tolist() == [len(x) for x in wanted] and ids.tolist() == sum(wanted, [])


def test_an_encoder_of_little_memory_gives_the_same_ids():
    texts = [" ".join(f"w{(i * j) % 701}." for i in range(60)) for j in range(1, 30)]
    small, large = Encoder(BYTES, memory=100), Encoder(BYTES)
    for _ in range(3):
        for first in range(0, len(texts), 5):
            few, many = (e.encode(texts[first : first + 5], 1) for e in (small, large))
            assert few[0].tolist() == many[0].tolist() and few[1].tolist() == many[1].tolist()
    assert small._most == 100 and len(small._number) < len(large._number)
