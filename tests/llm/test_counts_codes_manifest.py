"""Token counts, vector codes and the Merkle manifest against plain Python, and every SQL text of the subpackage."""

import hashlib
import math
import os
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from check import compare
from clickmill.llm import manifest, registry, token_counts, vector_codes
from clickmill.llm.common import prepare
from clickmill.llm.registry import TOKENIZER

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def spark_(spark):
    return prepare(spark)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables are absent")
@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_its_sql(spark_, name):
    same, note = compare(spark_, name, SMALL)
    assert same, note


# --- token counts ---------------------------------------------------------------------------------------------------

PIECES = ["a", "b", "e", "th", "ing", " ", "  ", "\n", "\t", "'", "re", "ve", "ll", "s", "1", "23", "é", "ß", "中", "文", "😀", "!",
          "--", "==", "<|endoftext|>", "<|end", "|>", " ", "_", "\x85", "aaaa", "    ", "x", "　", "½", "Ᲊ"]


def texts(n, seed=5):
    r = random.Random(seed)
    return ["".join(r.choice(PIECES) for _ in range(r.randrange(1, 25))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(TOKENIZER)


def exact(library, text):
    return len(library.encode(text, add_special_tokens=False).ids)


def test_every_prefix_has_its_exact_count(library):
    counter = token_counts.PrefixCounter(open(TOKENIZER, "rb").read())
    some = texts(300) + ["we've they're I'll don't", "a  b   c \n\n d", "<|endoftext|><|endoftext|> x<|endoftext|", ""]
    for text, counts in zip(some, counter.counts(some)):
        assert counts.tolist() == [exact(library, text[:k]) for k in range(len(text) + 1)], text


def test_long_pretokens_pieces_and_a_forgetful_cache(library, monkeypatch):
    monkeypatch.setattr(token_counts, "PIECE", 50)
    monkeypatch.setattr(token_counts, "CACHE_BYTES", 2000)
    monkeypatch.setattr(token_counts, "MOST_PAIRS", 50)
    r = random.Random(2)
    some = ["".join(r.choice("abcXYZ") for _ in range(20_000)), "a" * 5000, "word and more  " * 400, "\n" * 700 + "end"] + texts(40, 9)
    counter = token_counts.PrefixCounter(open(TOKENIZER, "rb").read())
    for text in some:
        counts = counter.counts([text])[0]
        assert counts[-1] == exact(library, text)
        for k in r.sample(range(len(text) + 1), min(20, len(text) + 1)):
            assert counts[k] == exact(library, text[:k])


def test_truncation_and_budgets_are_look_ups(spark_, library):
    rows = [(i, t, 7, "x") for i, t in enumerate(texts(60) + ["long text " * 3000])] + [(100, None, 7, "x"), (101, "", 7, "x"), (3, "same", 7, "x")]
    docs = spark_.createDataFrame(rows, "doc_id long, text string, n_tokens int, prefix_counts string")
    counted = token_counts.prefix_counts(docs, TOKENIZER)
    assert counted.columns == docs.columns
    limit = 5
    cut = {(r.doc_id, r.text): r for r in counted.select(
        "doc_id", "text", token_counts.n_tokens(F.col("prefix_counts")).alias("n"),
        token_counts.tokens_in(F.col("prefix_counts"), 4).alias("of_four"),
        token_counts.longest_prefix(F.col("prefix_counts"), limit).alias("fits"),
        token_counts.longest_prefix(F.col("prefix_counts"), -1).alias("none")).collect()}
    for i, text, *_ in rows:
        r, text_ = cut[i, text], text or ""
        assert (r.n, r.of_four, r.none) == (exact(library, text_), exact(library, text_[:4]), 0)
        near = range(min(len(text_), 200) + 1)
        assert r.fits == max(k for k in near if exact(library, text_[:k]) <= limit)
    short = token_counts.truncate(counted, limit).collect()
    assert all(exact(library, r.text or "") <= limit and len(r.prefix_counts) == len(r.text or "") + 1 for r in short)

    order = [F.col("doc_id").asc(), F.col("text").asc_nulls_first()]
    paid = token_counts.fill_budget(counted, 300, order).orderBy(*order).collect()
    left = 300
    for r in paid:
        n = exact(library, r.text or "")
        if left <= 0:
            assert r.budget_chars == 0
        elif n <= left:
            assert r.budget_chars == len(r.text or "")
        else:
            assert exact(library, r.text[:r.budget_chars]) <= left < exact(library, r.text[:r.budget_chars + 1])
        left -= n


def test_token_digest(spark_, library):
    rows = [(i, t) for i, t in enumerate(texts(30))] + [(50, None), (51, "many words " * 400), (None, "x")]
    docs = spark_.createDataFrame(rows, "doc_id long, text string")
    got = rows_of(token_counts.token_count_digest(docs, TOKENIZER).drop("chars_within_limit"))
    want = [(i, len((t or "").encode()), exact(library, t or ""), exact(library, t or "") > 512) for i, t in rows]
    assert got == sorted(want, key=repr)
    assert token_counts.token_count_digest(docs.limit(0), TOKENIZER).count() == 0


def test_other_tokenizers_are_refused(spark_):
    import public_tokenizers
    docs = spark_.createDataFrame([(1, "x")], "doc_id long, text string")
    with pytest.raises(ValueError):
        token_counts.prefix_counts(docs, public_tokenizers.path("word_bpe_49k.json"))


# --- vector codes ---------------------------------------------------------------------------------------------------

def codes_by_hand(rows):
    kept = [r for r in rows if r.embedding is not None and all(x is not None and math.isfinite(x) for x in r.embedding)]
    kept.sort(key=lambda r: (r.vec_id is None, r.vec_id or 0, r.embedding))
    whole = [[math.floor(256 * x) for x in r.embedding] for r in kept]
    w = len(whole[0]) // 16
    books = [[x[p * w:(p + 1) * w] for x in whole[:64]] for p in range(16)]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(x[p * w:(p + 1) * w], c)), k) for k, c in enumerate(books[p]))
                 for p in range(16)] for x in whole]

    for _ in range(2):
        near = assign()
        for p in range(16):
            for k in range(len(books[p])):
                mine = [x[p * w:(p + 1) * w] for x, r in zip(whole, near) if r[p][1] == k]
                if mine:
                    books[p][k] = [sum(c) // len(mine) for c in zip(*mine)]
    near = assign()
    sha = hashlib.sha256(",".join(str(n) for p in books for e in p for n in e).encode()).hexdigest()
    errors = [sum(d for d, _ in r) for r in near]
    total = {}
    for r, e in zip(kept, errors):
        total[r.label] = total.get(r.label, 0) + e
    return sorted(((r.vec_id, "".join(f"{k:02x}" for _, k in z), e, total[r.label], sha)
                   for r, z, e in zip(kept, near, errors)), key=repr)


VECTORS = "vec_id long, embedding array<double>, label int, code string"


def vectors(n, seed=3, width=32):
    r, nan = random.Random(seed), float("nan")
    rows = [(i % 70 if i % 9 else None, [r.choice([-1.5, 0.25, 0.1, 3.0, 0.0, -0.001, r.random()]) for _ in range(width)],
             r.choice([1, 2, None]), "x") for i in range(n)]
    bad = [None, [nan] * width, [None] + [0.0] * (width - 1), [float("-inf")] + [0.0] * (width - 1)]
    return rows + [(500 + k, v, 1, "x") for k, v in enumerate(bad)] + rows[:3]


@pytest.mark.parametrize("n", [20, 200])
def test_codes_equal_plain_assignment(spark_, n):
    rows = spark_.createDataFrame(vectors(n), VECTORS).repartition(5)
    assert rows_of(vector_codes.code_digest(rows)) == codes_by_hand(rows.collect())


def test_codes_of_nothing_and_of_odd_vectors(spark_):
    rows = spark_.createDataFrame(vectors(5), VECTORS)
    assert vector_codes.code_digest(rows.limit(0)).count() == 0
    assert vector_codes.code_digest(rows.where("vec_id >= 500")).count() == 0
    for odd in ([1.0] * 30, [1.0] * 48, [1e30] * 32):
        more = rows.unionByName(spark_.createDataFrame([(900, odd, 1, "x")], VECTORS))
        with pytest.raises(Exception, match="vectors differ|too large"):
            vector_codes.code_digest(more).collect()


def test_tables_give_the_distances_and_codes_decode(spark_):
    matrix = np.random.default_rng(1).integers(-300, 300, (500, 32))
    block = vector_codes.Block.build(matrix)
    book = matrix[:7, 4:6]
    assert (block.distances(2, book) == ((matrix[:, None, 4:6] - book[None]) ** 2).sum(2)).all()
    rows = spark_.createDataFrame(vectors(100), VECTORS)
    codes, books = vector_codes.compress(rows)
    for r in vector_codes.decompress(codes, books).collect():
        assert r.approximate == [x / 256 for p, k in enumerate(r.code) for x in books[p, k].tolist()]


# --- manifest -------------------------------------------------------------------------------------------------------

def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(r, more=0):
    values = (r.doc_id, r.source, r.lang, None if r.n_chars is None else r.n_chars + more, r.text)
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def manifest_by_hand(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r.lang, []).append((r.doc_id is not None, r.doc_id or 0, leaf(r), r))

    def tree(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([sha("".join(levels[-1][k:k + 2])) for k in range(0, len(levels[-1]), 2)])
        return levels

    def path(levels, k):
        for level in levels[:-1]:
            other = k ^ 1
            yield (level[other] if other < len(level) else None), other < k
            k >>= 1

    langs = sorted(groups, key=lambda name: (name is not None, (name or "").encode()))
    trees = {name: tree([x[2] for x in sorted(groups[name], key=lambda x: x[:3])]) for name in langs}
    top = tree([trees[name][-1][0] for name in langs])
    root, out = top[-1][0], []
    for place, name in enumerate(langs):
        for k, x in enumerate(sorted(groups[name], key=lambda x: x[:3])):
            proof = [*path(trees[name], k), *path(top, place)]
            touched = x[3].doc_id is not None and zlib.crc32(str(x[3].doc_id).encode()) % 7 == 0
            node = leaf(x[3], 1) if touched else x[2]
            for sibling, left in proof:
                node = sha(node if sibling is None else sibling + node if left else node + sibling)
            out.append((x[3].doc_id, x[2], trees[name][-1][0], root, sha("".join(s for s, _ in proof if s)), node, node == root))
    return sorted(out, key=repr)


DOCS = "doc_id long, text string, lang string, source string, n_chars long, leaf string, tree long, pos string"


@pytest.mark.parametrize("levels", [1, 2, 10])
def test_manifest_equals_a_plain_tree(spark_, levels):
    rows = [((1 << 60) + i % 7 if i % 11 else None, "é" * (i % 5) if i % 3 else None, [None, "", "é", "zh", "zh", "zh"][i % 6], "s",
             i if i % 6 else None, "x", 1, "y") for i in range(90)]
    docs = spark_.createDataFrame([*rows, (5, "long " * 20_000, "zh", None, 3, "x", 1, "y")], DOCS).repartition(3)
    got = rows_of(manifest.manifest_digest(docs, levels))
    assert got == manifest_by_hand(docs.collect())
    assert {r[-1] for r in got} == {True, False}


def test_manifest_of_one_row_and_of_none(spark_):
    docs = spark_.createDataFrame([(1, "a", None, None, None, "x", 1, "y")], DOCS)
    assert rows_of(manifest.manifest_digest(docs)) == manifest_by_hand(docs.collect())
    assert manifest.manifest_digest(docs.limit(0)).count() == 0


def test_stored_proofs_fold_to_the_root(spark_):
    docs = spark_.createDataFrame([(i, str(i), "en", "s", i, "x", 1, "y") for i in range(37)], DOCS)
    for r in manifest.manifest(docs, levels=2).collect():
        assert manifest.fold(r.leaf, r.siblings, r.sides) == r.root == r.folded_root
        assert manifest.fold(r.leaf[::-1], r.siblings, r.sides) != r.root
