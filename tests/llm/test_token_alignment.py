"""Token alignment against whole-text encodings, byte ranges and dictionaries."""

import hashlib
import json
from collections import Counter, defaultdict

import pyarrow.parquet as pq
import pytest
import sentencepiece
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyfold.llm import queries, token_alignment
from tallyfold.llm.bpe import byte_symbols

from conftest import SF_SMALL

A = tokenizers.Tokenizer.from_file(queries.ALIGNED_A)
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=queries.ALIGNED_B)
BYTE = {s: i for i, s in enumerate(byte_symbols())}
COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def b_bytes(i):
    piece = B.id_to_piece(i)
    return bytes([int(piece[3:5], 16)]) if B.is_byte(i) else piece.replace("▁", " ").encode()


def ranges(ids, parts):
    out, at = [], 0
    for i, p in zip(ids, parts):
        out.append((i, at, at + len(p)))
        at += len(p)
    return out


def whole(text):
    """n_a, n_b, groups and links of a text encoded at once."""
    if not text:
        return 0, 0, [], []
    data = f" {text}".encode()
    a, b = A.encode(f" {text}", add_special_tokens=False).ids, B.encode(text)
    pa = [bytes(BYTE[c] for c in A.id_to_token(i)) for i in a]
    pb = [b_bytes(i) for i in b]
    if b"".join(pa) != data or b"".join(pb) != data:
        return 0, 0, [], []
    ra, rb = ranges(a, pa), ranges(b, pb)
    cuts = sorted({e for *_, e in ra} & {e for *_, e in rb})
    ga, gb = defaultdict(list), defaultdict(list)
    for r, g in ((ra, ga), (rb, gb)):
        k = 0
        for i, _, e in r:
            g[k].append(i)
            k += e == cuts[k]
    groups = [f"{','.join(map(str, ga[k]))}|{','.join(map(str, gb[k]))}" for k in range(len(cuts))]
    links, j = [], 0
    for i, s, e in ra:
        while rb[j][2] <= s:
            j += 1
        k = j
        while k < len(rb) and rb[k][1] < e:
            links.append((i, rb[k][0]))
            k += 1
    return len(a), len(b), groups, links


def brute(rows):
    found = [(doc_id, *whole(text)) for doc_id, text in rows]
    held = Counter(link for *_, links in found for link in set(links))
    most = defaultdict(int)
    for (a, _), n in held.items():
        most[a] = max(most[a], n)
    return sorted(((d, na, nb, len(g), len(x), sum(held[p] == most[p[0]] for p in x), sum(held[p] for p in x),
                    hashlib.sha256(";".join(g).encode()).hexdigest() if g else "") for d, na, nb, g, x in found), key=str)


def run(spark, rows, **more):
    docs = spark.createDataFrame([(*r, 5, [1], "x") for r in rows],
                                 "doc_id long, text string, n_a int, same array<int>, rid string")
    v = token_alignment.Vocabularies(spark, queries.ALIGNED_A, queries.ALIGNED_B)
    found = token_alignment.score_links(token_alignment.digests(token_alignment.align(docs, v)), v, **more)
    return sorted((tuple(r[c] for c in COLUMNS) for r in found.collect()), key=str)


def corpus(n):
    t = pq.read_table(f"{SF_SMALL}/documents.parquet", columns=["doc_id", "text"]).slice(0, n).to_pylist()
    return [(r["doc_id"], r["text"]) for r in t]


STRANGE = ["", None, " ", "  ", "a", " a", "a ", "a  b", "x \n y", "a\nb c\td", "\r\n", "ñ ñ", "é é", "▁a b", "a▁ b",
           "😀 😀😀", "<|endoftext|> a <s> </s> <unk> <0x41>", "\x00 \x1c \x1f a", "a b ᠎ c　 d e",
           "﻿ ​ x", "don't  I'll we've", "١٢ ٣ Ⅳ ①", "aaa aaaa aaaaa " * 9, "日本語 の テキスト", "=" * 300, "a b" * 200]


@pytest.mark.parametrize("part_chars", [token_alignment.PART_CHARS, 1, 40])
def test_batches_and_parts_give_the_tokens_of_the_whole_text(part_chars):
    with open(queries.ALIGNED_A, encoding="utf-8") as f, open(queries.ALIGNED_B, "rb") as g:
        aligner = token_alignment.Aligner(f.read(), g.read(), part_chars)
    assert aligner._part_chars and aligner._ranked

    def same(*texts):
        got = aligner.align(list(texts))
        for i, text in enumerate(texts):
            na, nb, groups, links = whole(text)
            mine = got.link_text == i
            assert [x[i] for x in got[:5]] == [na, nb, len(groups), len(links), ";".join(groups)], text
            assert list(zip(got.link_a[mine], got.link_b[mine], got.link_same[mine])) == [
                (a, b, aligner.same[a] == b) for a, b in links]

    same()
    same(*STRANGE)
    same(*[t for _, t in corpus(60)], None)
    for text in STRANGE:
        same(text)

    @settings(max_examples=300, deadline=None, derandomize=True)
    @given(st.lists(st.one_of(st.text(max_size=4), st.sampled_from([" ", "  ", "\n", "\t", "'s", "The", "ing", ".", "\x85"])),
                    max_size=14))
    def random_texts(parts):
        same("".join(parts))

    random_texts()


@pytest.mark.parametrize("hot", [token_alignment.HOT_PAIRS, 40, 1])
def test_counts_equal_brute_force_whatever_is_hot(spark, hot):
    rows = corpus(60) + [(10_000 + i, t) for i, t in enumerate(STRANGE)]
    rows += [(7, STRANGE[-1]), (7, STRANGE[-1]), (None, "lala lala"), (None, None)]
    assert run(spark, rows, hot_pairs=hot) == brute(rows)


def test_empty_table_one_text_and_no_irregular_links(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None), (2, "")]) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]
    assert run(spark, [(1, "the")]) == brute([(1, "the")])


def test_a_long_text(spark):
    rows = [(1, " ".join(t for _, t in corpus(200))), (2, "x" * 20_000), (3, "short one")]
    assert run(spark, rows) == brute(rows)


def test_query_over_the_smallest_tables(spark):
    t = pq.read_table(f"{SF_SMALL}/documents.parquet").to_pylist()
    got = queries.op12_token_alignment(spark, SF_SMALL).collect()
    assert sorted((tuple(r[c] for c in COLUMNS) for r in got), key=str) == brute([(r["doc_id"], r["text"]) for r in t])


def test_identity_map_holds_the_same_bytes():
    with open(queries.ALIGNED_A, encoding="utf-8") as f, open(queries.ALIGNED_B, "rb") as g:
        spec, model = f.read(), g.read()
    aligner = token_alignment.Aligner(spec, model)
    assert len(aligner.same) == max(json.loads(spec)["model"]["vocab"].values()) + 2
    assert all(b < 0 or aligner.a_bytes[a] == b_bytes(b) for a, b in enumerate(aligner.same))
    assert sum(b >= 0 for b in aligner.same) > 10_000
