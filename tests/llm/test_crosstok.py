"""Cross-tokenizer alignment against a brute force over every pair of tokens."""

import base64
import hashlib
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from feedback_engine.llm import crosstok

BYTE_LEVEL, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")

TEXTS = [
    "Hello  world, tokenizers differ.", "Hello  world, tokenizers differ.", "", None, " leading and trailing ",
    "naïve café — déjà vu 😀 ​ x\n\ttabs", "a▁b", "<|endoftext|> and <s> </s> <unk> <0x41>", "▁", " ", "\x00\x01 nul",
    "word " * 30, "日本語のテキスト", "x" * 300, "é combining", "the the the the",
]


@pytest.fixture(scope="module")
def slow():
    a = Tokenizer.from_file(BYTE_LEVEL)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        spelled = {int(rank): base64.b64decode(entry) for entry, rank in map(bytes.split, file)}

    def tokens(text):
        """(id, start, end) of each token by A and by B; nothing where they do not spell the text."""
        if not text:
            return [], []
        first = [(i, spelled[i]) for i in a.encode(" " + text, add_special_tokens=False).ids]
        second = []
        for i in b.encode(text):
            piece = b.id_to_piece(i)
            second.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
        both = []
        for side in (first, second):
            if b"".join(x for _, x in side) != (" " + text).encode():
                return [], []
            at, placed = 0, []
            for i, x in side:
                placed.append((i, at, at + len(x)))
                at += len(x)
            both.append(placed)
        return both

    def run(texts):
        rows, counts = [], Counter()
        for text in texts:
            first, second = tokens(text)
            links = [(i, j) for i, s, e in first for j, t, f in second if max(s, t) < min(e, f)]
            counts.update(links)
            shared = sorted({e for _, _, e in first} & {e for _, _, e in second})
            groups, start = [], 0
            for end in shared:
                sides = (",".join(str(i) for i, s, e in side if start < e <= end) for side in (first, second))
                groups.append("|".join(sides))
                start = end
            rows.append((len(first), len(second), groups, links))
        highest = Counter()
        for (_, j), n in counts.items():
            highest[j] = max(highest[j], n)
        return [
            (
                n_a, n_b, len(groups), ";".join(groups), len(links),
                sum(counts[link] == highest[link[1]] for link in links), sum(counts[link] for link in links),
            )
            for n_a, n_b, groups, links in rows
        ]

    return run


def got(spark, rows, **more):
    docs = spark.createDataFrame(rows, "doc_id long, text string, chunk int, pairs string, id string")
    made = crosstok.aligned(docs, BYTE_LEVEL, PIECES, **more)
    assert made.columns == ["doc_id", "n_a", "n_b", "n_groups", "groups", "n_links", "n_best", "count_sum"]
    return sorted(map(tuple, made.collect()), key=repr)


def test_equals_brute_force(spark, slow):
    rows = [(k, text, 1, "p", "i") for k, text in enumerate(TEXTS)] + [(0, "repeated id", 1, "p", "i"), (None, "no id", 1, "p", "i")]
    expected = [(row[0], *made) for row, made in zip(rows, slow([row[1] for row in rows]))]
    assert got(spark, rows) == sorted(expected, key=repr)
    hashed = [(*row[:4], hashlib.sha256(row[4].encode()).hexdigest() if row[1] else "", *row[5:]) for row in expected]
    assert got(spark, rows, digest=True) == sorted(hashed, key=repr)


def test_documents_of_the_tables(spark, slow):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("length(text) < 3000").orderBy("doc_id")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    expected = [(row[0], *made) for row, made in zip(rows, slow([row[1] for row in rows]))]
    made = crosstok.aligned(docs, BYTE_LEVEL, PIECES)
    assert sorted(map(tuple, made.collect()), key=repr) == sorted(expected, key=repr)


def test_pieces_change_no_token():
    text = ("Some words, 12 numbers and  spaces; naïve text s <s> don't stop. " * 50 + "x" * 900 + " y ") * 3
    with open(PIECES, "rb") as b, open(BYTE_LEVEL, encoding="utf-8") as a:
        both = crosstok.Tokenizers(a.read(), b.read())
    assert len(crosstok._SEAM.split(text)) > 500
    odd = ["a" + x + y + "b c" for x in (" ", "▁", "\n", "\u2003", "\x1c", "́", "²", ".") for y in (" ", "▁", "\n", "²", "!", "é")]
    texts = [text, "", "a b", "a  b c", " a b", "a b ", "a b, c. d!", *odd, *[t + " x" for t in odd]]
    for t in texts:
        assert crosstok._pieces(t) == crosstok._SEAM.split(t)
    first, second = (side.to_pylist() for side in both.encode(texts))
    assert first == [both.a.encode(" " + t, add_special_tokens=False).ids if t else [] for t in texts]
    assert second == [both.b.encode(t) for t in texts]


def test_no_rows(spark):
    assert got(spark, []) == []
    assert got(spark, [(1, None, 1, "p", "i"), (2, "", 1, "p", "i")]) == [(1, 0, 0, 0, "", 0, 0, 0), (2, 0, 0, 0, "", 0, 0, 0)]
