"""The text operators against plain Python on small tables: nulls, empty and long texts, ties, copies, extra columns."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from clickmill.llm import (
    bpe, components, decontaminate, line_dedup, pii, preferences, quality_model, quality_rules, shards, simhash, suffix_dedup)
from clickmill.llm.common import prepare
from clickmill.llm.registry import RANKS
from clickmill.llm.suffix_sort import deep_shallow

WORDS = "the and of in to for a is that on with éa über ñu 12 x! y. #z".split()


@pytest.fixture(scope="module")
def spark_(spark):
    return prepare(spark)


def make(spark, rows, extra="fp string, size long, key string"):
    """A documents table with columns whose names clash with what operators add."""
    return spark.createDataFrame([(*r, "x", 1, "k") for r in rows], f"doc_id long, text string, {extra}")


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def prose(r, n):
    return " ".join(r.choice(WORDS) + (r.choice(["", "\n"]) if r.random() < 0.1 else "") for _ in range(n))


def sample_rows(seed=0, n=40):
    r = random.Random(seed)
    rows = [(i, prose(r, r.choice([1, 4, 60, 150]))) for i in range(n)]
    rows += [(n + k, rows[k][1]) for k in range(8)]                                    # exact copies
    rows += [(n + 20 + k, rows[k][1].replace("the", "thee", 1)) for k in range(8)]     # near copies
    rows += [(900, None), (901, ""), (902, " \n\t"), (903, "long " * 4000), (904, "x" * 3000), (5, rows[5][1]), (None, "null id")]
    return rows


def test_preference_pairs(spark_):
    turns = [(1, 0, "user", "hi"), (1, 1, "assistant", "yes"), (1, 2, "user", "and"), (1, 3, "assistant", None),
             (1, 3, "assistant", None), (2, None, "system", "s"), (2, 0, None, "q"), (3, 0, "user", "only"), (None, 0, "user", "x")]
    rows = spark_.createDataFrame([(*t, "c") for t in turns], "conv_id long, turn long, role string, text string, pair_id string")
    grouped = {r.conv_id: [(t.role, t.text) for t in r.turns] for r in preferences.conversations_to_rows(rows).collect()}
    assert grouped == {1: [("user", "hi"), ("assistant", "yes"), ("user", "and"), ("assistant", "")],
                       2: [("system", "s"), ("", "q")], 3: [("user", "only")]}
    pair = "pair_id long, turns array<struct<role:string,text:string>>"
    chosen = spark_.createDataFrame([(1, grouped[1]), (2, grouped[2]), (3, grouped[3]), (4, [])], pair)
    rejected = spark_.createDataFrame([(1, [("user", "hi"), ("assistant", "no")]), (2, grouped[2]), (3, []), (5, [])], pair)
    out = {r.pair_id: r for r in preferences.preference_pairs(chosen, rejected).collect()}
    assert set(out) == {1, 3}                                                           # equal or one-sided pairs go
    assert out[1].n_prompt_turns == 1 and out[1].prompt == "<|user|>\nhi<|end|>\n"
    assert out[1].rejected == "<|assistant|>\nno<|end|>\n" and out[1].prompt not in out[1].chosen
    spans = [(s.start, s.stop, s.trained) for s in out[1].chosen_mask]
    assert [out[1].chosen[a:b].split("|")[1] for a, b, _ in spans] == ["assistant", "user", "assistant"]
    assert [t for *_, t in spans] == [True, False, True] and spans[-1][1] == len(out[1].chosen)
    assert out[3].rejected == "" and out[3].rejected_mask == []
    assert preferences.preference_pairs(*preferences.reply_swaps(rows.limit(0))).count() == 0


PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def accepted(kind, s):
    d = re.sub("[^0-9]", "", s)
    total = sum((2 * int(c) - 9 if int(c) > 4 else 2 * int(c)) if i % 2 else int(c) for i, c in enumerate(reversed(d)))
    return {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in s.split(".")),
            "card": 13 <= len(d) <= 19 and total % 10 == 0, "phone": 9 <= len(d) <= 15}[kind]


def test_personal_data_base_spans(spark_):
    texts = ["", None, "a@b.c@d.e x@y.z_q@r.s", "1.2.3.4.5.6.7.8 300.1.1.1 001.02.3.255", "4111 1111 1111 1111 4111-1111-1111-1111 12  34",
             "+1 (017) 555-7713 +49.89.1234 +1 2 3", "é😀 a@b.co +12 345 678 90", "9" * 3000, " ".join("12" * 2000), "x" * 50000, "x@y.z " * 200,
             "a at b" + " dot c" * 20000, "a [at] b" + ".c" * 20000, "a [at] " * 10000, "1 . " * 10000, "(1" * 20000, "1[.]2 " * 2000]
    docs = make(spark_, list(enumerate(texts)))
    digest = {r.doc_id: r for r in pii.personal_data_digest(docs).collect()}
    for i, text in enumerate(texts):
        spans = [f"{k}:{m.start()}:{m.end()}" for k, p in PLAIN.items() for m in re.finditer(p, text or "") if accepted(k, m.group())]
        assert digest[i].base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest(), text
        assert set(spans) <= set(digest[i].spans.split(",")) | {""}
    assert pii.personal_data_digest(docs.limit(0)).count() == 0


def test_trees_add_secrets_and_redaction_covers_all(spark_):
    r = random.Random(3)
    secret = lambda: "".join(r.choice("0123456789abcdef") for _ in range(40))
    rows = [(i, f'{prose(r, 20)} token = "{secret()}" and a{i}@b.co or order12345678901234567x {prose(r, 5)}') for i in range(200)]
    found = pii.find_personal_data(make(spark_, rows)).cache()
    added = {x.doc_id: [(a.kind, x.text[a.start:a.end]) for a in x.added] for x in found.collect()}
    hits = sum(any(k == "secret" and len(s) == 40 for k, s in v) for v in added.values())
    assert hits > 190 and not any("order" in s for v in added.values() for _, s in v)
    line = pii.redact(found).where("doc_id = 7").first().redacted
    assert "<secret>" in line and "<email>" in line and "a7@b.co" not in line


def luhn_number(r):
    while True:
        s = "4" + "".join(r.choice("0123456789") for _ in range(15))
        if accepted("card", s):
            return s


def planted_personal_data(r, n):
    """Rows of plain personal data, of variants that the base rules miss (with their kind and text) and of decoys."""
    phone = lambda: (r.randrange(200, 990), r.randrange(200, 990), r.randrange(1000, 9999))
    ip = lambda sign: sign.join(str(r.randrange(1, 255)) for _ in range(4))
    token = lambda: "".join(r.choice("0123456789abcdef") for _ in range(40))
    name = lambda: r.choice(["ann", "bob", "li", "max"]) + str(r.randrange(1000))
    host = lambda: f"mail{r.randrange(9)}.example.com"
    plain = [lambda: f"{name()}@{host()}", lambda: "+1 (%d) %d-%d" % phone(), lambda: ip("."),
             lambda: luhn_number(r), lambda: f'token = "{token()}"']
    missed = [("email", lambda: f"{name()} [at] {host()}"), ("email", lambda: f"{name()}(at){host().replace('.', '[dot]')}"),
              ("email", lambda: f"{name()} at {host().replace('.', ' dot ')}"), ("phone", lambda: "(%d) %d-%d" % phone()),
              ("ip", lambda: ip("[.]")), ("ip", lambda: ip(" . ")),
              ("card", lambda: re.sub("(....)(?=.)", r"\1.", luhn_number(r))), ("secret", lambda: f'{token()}')]
    decoys = [lambda: "version %d.%d.%d" % (r.randrange(9), r.randrange(30), r.randrange(99)), lambda: f"order {r.randrange(10**7, 10**8)}",
              lambda: "on 20%d-%02d-%02d %02d:%02d" % (r.randrange(10, 30), r.randrange(1, 13), r.randrange(1, 28), r.randrange(24), r.randrange(60)),
              lambda: f"meet at noon{r.randrange(99)}. then go", lambda: f"build_release_name_{r.randrange(10**4)}_final",
              lambda: "pages %d/%d" % (r.randrange(10, 99), r.randrange(100, 999)), lambda: "polka dot %d" % r.randrange(99)]
    rows, want, clean = [], {}, set()
    for i in range(n):
        parts = [f"{prose(r, 6)} {f()} and {prose(r, 4)}" for f in plain]
        rows.append((i, " or ".join(parts)))
    for i in range(n, 2 * n):
        kind, make_one = missed[i % len(missed)]
        one = make_one()
        text = f"the man said {one} and left {prose(r, 4)}"
        rows.append((i, text))
        want[i] = (kind, text.index(one), text.index(one) + len(one))
    for i in range(2 * n, 4 * n):
        rows.append((i, f"the man said {decoys[i % len(decoys)]()} and left {prose(r, 4)}"))
        clean.add(i)
    return rows, want, clean


def test_trees_add_what_the_base_rules_miss(spark_):
    rows, want, clean = planted_personal_data(random.Random(8), 240)
    found = pii.find_personal_data(make(spark_, rows)).collect()
    added = {x.doc_id: [(a.kind, a.start, a.end) for a in x.added] for x in found}
    for kind in pii.KINDS:
        mine = [i for i, (k, *_) in want.items() if k == kind]
        assert sum(want[i] in added[i] for i in mine) >= 0.9 * len(mine), (kind, [(rows[i][1], added[i]) for i in mine][:5])
    right = sum(any(s < b and a < e for _, s, e in added[i]) for i, (_, a, b) in want.items())
    wrong = [(rows[i][1], added[i]) for i in clean if added[i]]
    assert right >= 0.95 * (right + len(wrong)), wrong[:10]
    trees = [f for _, t in pii_features(pii.fit_selector(pii.materialize(pii.scan(make(spark_, rows)), "pii-test"))) for f in t]
    assert {"luhn", "n_digits"} & set(trees)


def pii_features(selector):
    """Names of the features that each tree splits on."""
    def used(node):
        return [] if not isinstance(node, tuple) else [pii.FEATURES[node[0]], *used(node[2]), *used(node[3])]
    return [(w, used(t)) for w, t in selector.trees]


def test_rare_secrets_are_found_among_many_documents(spark_):
    r = random.Random(4)
    token = lambda: "".join(r.choice("0123456789abcdef") for _ in range(40))
    rare = [(i * 1000, f'{prose(r, 5)} token = "{token()}" end') for i in range(6)]
    plain = [(i, f"order {token()}x and part{i:016d}z {prose(r, 3)}") for i in range(6000) if i % 1000]
    added = {}
    for rows in ([*rare, *plain[:100]], [*rare, *plain]):
        found = pii.find_personal_data(make(spark_, rows)).where(F.size("added") > 0).collect()
        added[len(rows)] = {x.doc_id: [(a.kind, a.start, a.end) for a in x.added] for x in found}
    few, many = added.values()
    assert set(many) == {i for i, _ in rare} and few == many


def test_quality_model(spark_):
    r = random.Random(1)
    good = [(i, prose(r, 80)) for i in range(300)]
    bad = [(1000 + i, " ".join(r.choice(["BUY!!", "$$$", "###"]) for _ in range(60))) for i in range(200)]
    docs = make(spark_, [*good, *bad, (5000, None), (5001, ""), (None, "x")])
    labels = spark_.createDataFrame([(i, 1, 0) for i, _ in good] + [(i, 0, 0) for i, _ in bad] + [(0, None, 0), (None, 1, 0), (3, 1, 0)],
                                    "doc_id long, quality int, toxic int")
    out = {x.doc_id: x for x in quality_model.quality_scores(docs, labels).collect()}
    assert len(out) == 503 and all(0 <= x.score <= 1 for x in out.values())
    held = [x for d, x in out.items() if d is not None and d < 5000 and x.held_out]
    assert held and all(x.held_out == (zlib.crc32(str(x.doc_id).encode()) % 4 == 2) for x in out.values() if x.doc_id is not None)
    assert np.mean([x.predicted == (x.doc_id < 1000) for x in held]) > 0.95
    assert not out[None].held_out
    none = quality_model.quality_scores(docs, labels.limit(0)).select("score").distinct().collect()
    assert [x.score for x in none] == [0.5]
    assert quality_model.quality_scores(docs.limit(0), labels).count() == 0


def test_flattened_trees_equal_a_walk():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    trees = quality_model.fit(x, y)
    for row in x[:20]:
        total = trees.start
        for f, b, leaf in zip(trees.feature, trees.bound, trees.leaf):
            node = 0
            while node < len(f):
                node = 2 * node + 1 + (row[f[node]] > b[node])
            total += leaf[node - len(f)]
        assert trees.scores(row[None])[0] == pytest.approx(1 / (1 + np.exp(-total)))
    assert np.mean((trees.scores(x) > 0.5) == y) > 0.95


def test_byte_bpe_equals_the_public_library(spark_, monkeypatch):
    monkeypatch.setattr(bpe, "MAX_PRETOKENS", 50)
    pieces = bpe.load_ranks(RANKS)
    public = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={p: i for i, p in enumerate(pieces)}, special_tokens={})
    odd = ["x" * 20000 + "  y's  \x1c z\n\n q²½Ⅷ_a__b 12٠ é́​　 日本語。 \U0001F600'll I'LL", " \x85 \n", "xy" * 150, None, "", "<|endoftext|>"]
    rows = [(i, t) for i, t in enumerate([*odd, *[t for _, t in sample_rows()]])]
    docs = make(spark_, rows)
    got = {r.doc_id: r for r in bpe.decode(bpe.encode(docs, RANKS), RANKS).collect()}
    for i, text in rows:
        want = public.encode_ordinary(text or "")
        assert np.frombuffer(got[i].ids, "<u4").tolist() == want and got[i].n_tokens == len(want), repr(text)[:60]
        assert bytes(got[i].decoded) == (text or "").encode() and got[i].key == "k"
    short = docs.where(F.length("text") < 2000).limit(12)
    by_functions = {r.doc_id: bytes(r.ids) for r in bpe.encode(short, RANKS, engine="functions").collect()}
    assert by_functions and all(bytes(got[i].ids) == ids for i, ids in by_functions.items())
    assert bpe.token_digest(docs.limit(0), RANKS).count() == 0
    for r in bpe.encode_and_decode(docs, RANKS).collect():
        assert (r.ids, r.n_tokens, r.decoded, r.key) == (got[r.doc_id].ids, got[r.doc_id].n_tokens, got[r.doc_id].decoded, "k")


@pytest.mark.parametrize("size", [401, 1000, 20_000])
def test_long_pretokens_on_both_engines(spark_, size):
    r = random.Random(size)
    texts = ["".join(r.choice("abcdefgh") for _ in range(size)), "ab " + "日" * (size // 3 + 1) + " c"]
    docs = make(spark_, list(enumerate(texts[:1 if size > 5000 else 2])))
    for engine in ("arrays", "functions"):
        done = bpe.decode(bpe.encode(docs, RANKS, engine=engine), RANKS).select("ids", "text", "decoded").collect()
        assert all(bytes(x.decoded).decode() == x.text for x in done)
        if engine == "arrays":
            want = {x.text: x.ids for x in done}
        assert {x.text: x.ids for x in done} == want


def test_ranges_are_even_though_texts_repeat(spark_):
    rows = [*[(i, "the same text " * 5) for i in range(600)], *[(1000 + i, f"text {i} " * (1 + i % 9)) for i in range(300)], (5000, "long " * 2000)]
    docs = make(spark_, rows)
    keys = docs.select(shards.key_of(shards.text_of(), F.col("doc_id")).alias("key"), (F.octet_length("text") + 8).alias("size"))
    bounds, cuts = shards.splitters(keys, 4, range_bytes=2000)
    assert set(bounds) <= set(cuts)
    held = Counter()
    for row in keys.collect():
        held[sum(cut <= row.key for cut in cuts)] += row["size"]
    ordinary = sorted(held.values())[:-1]                       # all but the range of the long text
    assert len(held) > 20 and max(ordinary) <= 2000 + 2 * 500 + 80
    one, many = (shards.assign_shards(docs, 4, range_bytes=b).select("doc_id", "shard", "slot") for b in (1 << 30, 2000))
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect()))
    plan = shards.assign_shards(docs, 4)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_histogram_shards(spark_):
    rows = [*sample_rows(), *[(2000 + i, "hot group") for i in range(300)]]
    out = shards.shard_digest(make(spark_, rows), 8, range_bytes=100).collect()
    key = lambda d, t: (hashlib.md5((t or "").encode()).hexdigest(), d if d is not None else -2**63)
    order = sorted(rows, key=lambda x: key(*x))
    total, below, want = sum(len((t or "").encode()) + 8 for _, t in rows), 0, defaultdict(list)
    for d, t in order:
        want[sum(below >= total * s // 8 for s in range(1, 8)) if (d, t) != order[0] else 0].append((d, t))
        below += len((t or "").encode()) + 8
    placed = {(x.doc_id, x.slot, x.shard) for x in out}
    assert len(out) == len(rows) and len(placed) == len(rows)
    for shard in range(8):
        mine = sorted((x.slot, x.doc_id) for x in out if x.shard == shard)
        assert [s for s, _ in mine] == list(range(len(mine)))
    same = Counter((d, s) for s, rows_ in want.items() for d, _ in rows_)
    got = Counter((x.doc_id, x.shard) for x in out)
    twice = {d for d, n in Counter(d for d, _ in rows).items() if n > 1}                # equal keys stay together
    assert {k: v for k, v in got.items() if k[0] not in twice} == {k: v for k, v in same.items() if k[0] not in twice}
    assert all(x.text_crc32 == zlib.crc32((dict(rows)[x.doc_id] or "").encode()) for x in out)
    assert shards.shard_digest(make(spark_, rows).limit(0)).count() == 0


def test_line_windows(spark_):
    a = "\n".join(f"line {i}" for i in range(8))
    rows = [(1, a), (2, "new\n" + a + "\nend"), (3, "line 1\nline 2"), (4, "\n\n\n\n"), (5, "\n\n\n\n"), (6, None), (7, ""), (8, "p\nq\nr\np\nq\nr\np"),
            (1, a), (None, "line 5\nline 6\nline 7\nzz")]
    out = defaultdict(set)
    for r in line_dedup.dedup_lines(make(spark_, rows)).collect():
        out[r.doc_id].add((r.text, tuple(r.removed_lines)))
    assert out[None] == {("line 5\nline 6\nline 7\nzz", ())}                            # the least id comes first
    assert out[1] == {("\n".join(f"line {i}" for i in range(5)), (5, 6, 7))}
    assert out[2] == {("new\nend", tuple(range(1, 9)))}
    assert out[3] == {("line 1\nline 2", ())} and out[4] == out[5] == {("\n\n\n\n", ())}
    assert out[6] == {(None, ())} and out[7] == {("", ())} and out[8] == {("p\nq\nr", (3, 4, 5, 6))}
    assert line_dedup.line_digest(make(spark_, rows).limit(0)).count() == 0


def test_lines_of_null_and_repeated_ids(spark_):
    lines = lambda name, n=8: "\n".join(f"{name} {i}" for i in range(n))
    rows = [(None, lines("a") + "\n" + lines("a", 4)), (None, lines("b", 14)), (4, lines("c", 14)), (4, "x\n" + lines("d") + "\n" + lines("d", 4)),
            (5, "new\n" + lines("c", 5)), (5, lines("e"))]
    out = {(r.doc_id, r.text.split("\n")[-1]): r.removed_lines for r in line_dedup.dedup_lines(make(spark_, rows)).collect()}
    assert out == {(None, "a 7"): [8, 9, 10, 11], (None, "b 13"): [], (4, "c 13"): [], (4, "d 7"): [9, 10, 11, 12],
                   (5, "new"): [1, 2, 3, 4, 5], (5, "e 7"): []}


def plain_print(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[i:i + 3]), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def test_simhash_groups(spark_, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 3)
    rows = sample_rows(2)
    out = simhash.simhash_digest(make(spark_, rows)).collect()
    prints = [(d, plain_print(t)) for d, t in rows]
    group = {p: p for _, p in prints}
    for _ in group:
        for p in group:
            for q in group:
                if bin(p ^ q).count("1") <= 3 and group[q] < group[p]:
                    group[p] = group[q]
    least = {}
    for d, p in prints:
        if d is not None:
            least[group[p]] = min(d, least.get(group[p], 1 << 60))
    assert Counter((d, f"{p:016x}", least.get(group[p])) for d, p in prints) == Counter(tuple(r) for r in out)
    assert simhash.simhash_digest(make(spark_, rows).limit(0)).count() == 0


def test_posting_links_and_components(spark_, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 4)
    r = random.Random(0)
    values = {0}
    for _ in range(60):                                                                 # a chain of near fingerprints
        v = r.choice(sorted(values))
        for b in r.sample(range(63), r.randint(1, 4)):
            v ^= 1 << b
        values.add(v)
    links = simhash.fingerprint_links(spark_.createDataFrame([(v,) for v in values], "fp long"))
    found = {r.node: r.root for r in components.connected_components(links).collect()}
    group = {v: v for v in values}
    for _ in values:
        for p in values:
            for q in values:
                if bin(p ^ q).count("1") <= 3:
                    group[p] = group[q] = min(group[p], group[q])
    assert {v: found.get(v, v) for v in values} == group


def test_quality_rules(spark_):
    rows = sample_rows(4)
    out = quality_rules.quality_digest(make(spark_, rows)).collect()
    want = Counter()
    for d, t in rows:
        w, t = words_of(t), t or ""
        seen = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
        repeat = {i + k for i in range(len(w) - 2) if seen[tuple(w[i:i + 3])] > 1 for k in range(3)}
        lines = [x for x in t.split("\n") if words_of(x)]
        failed = len(w) < 50 or 100 * len(repeat) > 50 * len(w)
        want[(d, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(repeat), failed)] += 1
    assert want == Counter((x.doc_id, x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words, x.base_failed) for x in out)
    assert all(not x.kept for x in out if x.base_failed) and all(x.kept == (x.failed_rules == 0) for x in out)
    kept_without = {r.rule: r for r in quality_rules.ablation(quality_rules.ledger(make(spark_, rows))).collect()}
    for rule, r in kept_without.items():
        bit = quality_rules.rule_bit(rule)
        assert r.n_failed == sum(bool(x.failed_rules & bit) for x in out)
        assert r.n_failed_alone == sum(x.failed_rules == bit for x in out)
        assert r.n_kept_without == sum(x.failed_rules & ~bit == 0 for x in out)
    assert quality_rules.quality_digest(make(spark_, rows).limit(0)).count() == 0


def test_contaminated_documents(spark_):
    r = random.Random(5)
    long = " ".join(f"w{r.randrange(10**6)}" for _ in range(20000)).split()
    item = " ".join(f"v{i}" for i in range(30))
    near = " ".join("changed" if i == 2 else f"v{i}" for i in range(30))
    rows = [(1, " ".join([*long[:9000], item.upper(), *long[9000:]])), (2, near), (3, " ".join(item.split()[:20])), (4, None), (5, ""),
            (6, "one two"), (None, item), (2, near), (7, item + " " + item)]
    items = spark_.createDataFrame([(10, item, "z"), (11, "one two", "z"), (12, None, "z"), (13, "", "z"), (None, item, "z")],
                                   "item_id long, text string, doc_id string")
    out = {(x.doc_id, x.item_id): x.containment for x in decontaminate.contaminated(make(spark_, rows), items).collect()}
    assert out == {(1, 10): 1.0, (2, 10): pytest.approx(23 / 26), (6, 11): 1.0, (7, 10): 1.0}
    left = decontaminate.decontaminate(make(spark_, rows), items).select("doc_id").collect()
    assert sorted(str(x.doc_id) for x in left) == ["3", "4", "5", "None"]
    assert decontaminate.contaminated(make(spark_, rows), items.limit(0)).count() == 0
    assert decontaminate.contaminated(make(spark_, rows).limit(0), items).count() == 0


def test_contaminated_documents_by_size_of_item(spark_):
    r = random.Random(12)
    items = [(i, " ".join(f"i{i}w{k}" for k in range(n))) for i, n in enumerate([3, 5, 6, 9, 14, 15, 24, 43, 44, 60, 200])]
    rows = []
    for i, text in items:
        words = text.split()
        for cut in range(0, max(1, len(words) // 4)):                                     # shorter and shorter passages
            around = [f"d{r.randrange(10**6)}" for _ in range(r.choice([0, 50, 3000]))]
            rows.append((len(rows), " ".join([*around, *words[cut:], *around])))
    want = {}
    grams = lambda w: {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)}
    for d, text in rows:
        for i, item in items:
            g = grams(item.split())
            n = len(g & grams(text.split()))
            if n >= 0.8 * len(g) - 1e-9:
                want[d, i] = (n, len(g))
    table = spark_.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contaminated(make(spark_, rows), table).collect()
    assert {(x.doc_id, x.item_id): (x.n_shared, x.n_shingles) for x in found} == want and len(want) > 40
    sketches = {x.item_id: x["count"] for x in decontaminate.item_tables(table)[1].groupBy("item_id").count().collect()}
    assert sketches == {0: 1, 1: 1, 2: 1, 3: 2, 4: 3, 5: 3, 6: 5, 7: 8, 8: 8, 9: 8, 10: 8}


def plain_cut(rows):
    first, key = {}, lambda d: -2**63 if d is None else d
    for d, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - 49):
            first[b[i:i + 50]] = min(key(d), first.get(b[i:i + 50], 2**63))
    out = Counter()
    for d, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - 49):
            if first[b[i:i + 50]] < key(d):
                gone[i:i + 50] = b"\x01" * 50
        kept = bytes(x for x, g in zip(b, gone) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        out[(d, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest())] += 1
    return out


@pytest.mark.parametrize("seed,many,small", [(0, 4096, False), (1, 3, True)])
def test_suffix_dedup(spark_, monkeypatch, seed, many, small):
    monkeypatch.setattr(suffix_dedup, "MANY", many)
    if small:
        monkeypatch.setattr(suffix_dedup, "BLOCK", 128)
        monkeypatch.setattr(suffix_dedup, "RANGE_BYTES", 2000)
    r = random.Random(seed)
    alphabet = ["ab", "abcdefgh é"][seed % 2]
    base = ["".join(r.choice(alphabet) for _ in range(r.choice([60, 100, 300]))) for _ in range(6)]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(r.choice([1, 3, 6])):
            x = r.choice(base)
            a, b = sorted(r.randrange(len(x)) for _ in range(2))
            parts.append(x[a:b] if r.random() < 0.8 else "".join(r.choice(alphabet) for _ in range(30)))
        rows.append((i if r.random() < 0.9 else r.choice([3, None]), "".join(parts)))
    rows += [(100, None), (101, ""), (102, "x" * 3000), (103, "x" * 200), (7, rows[7][1])]
    assert Counter(tuple(x) for x in suffix_dedup.suffix_digest(make(spark_, rows)).collect()) == plain_cut(rows)
    assert suffix_dedup.suffix_digest(make(spark_, rows).limit(0)).count() == 0


def test_suffix_dedup_tells_many_rows_of_one_id_apart(spark_):
    r = random.Random(4)
    passage = ["".join(r.choice("abcdefghij ") for _ in range(90)) for _ in range(30)]
    rows = [(5 if k % 3 else None, r.choice(passage)[:r.randrange(20, 90)] + str(k) + r.choice(passage)) for k in range(2000)]
    rows += [(9, x) for x in passage] + rows[:5]
    assert Counter(tuple(x) for x in suffix_dedup.suffix_digest(make(spark_, rows)).collect()) == plain_cut(rows)


def test_deep_shallow_sort():
    common = lambda a, b: next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b)))
    for seed in range(60):
        r = random.Random(seed)
        base = [bytes(r.choice(b"\x00ab") for _ in range(r.choice([0, 3, 8, 20, 30]))) for _ in range(4)]
        strings = [r.choice(base) + r.choice(base) + bytes(r.choice(b"\x00a") for _ in range(r.choice([0, 1, 9]))) for _ in range(r.choice([1, 2, 60]))]
        groups = np.array([r.randrange(3) for _ in strings])
        sizes = np.array([len(s) for s in strings])
        order, shared = deep_shallow(np.frombuffer(b"".join(strings) + b"z", np.uint8), np.cumsum(sizes) - sizes, sizes, groups)
        rows = [(groups[i], strings[i]) for i in order]
        assert rows == sorted(rows)
        for k in range(len(rows)):
            assert shared[k] == (-1 if k == 0 or rows[k][0] != rows[k - 1][0] else common(rows[k][1], rows[k - 1][1]))


def test_pipeline_stages(spark_, tmp_path):
    r = random.Random(9)
    text = lambda n: "\n".join(" ".join(''.join(r.choice('abcdefghx') for _ in range(6)) for _ in range(10)) for _ in range(n))
    clean = [(i, text(9)) for i in range(20)]
    copied = clean[0][1].split("\n")
    item = " ".join(f"item{i}q" for i in range(30))
    rows = [*clean, (100, clean[1][1]), (101, "\n".join(copied[:4]) + "\n" + text(8)), (102, "few words"), (103, "$$$ ### " * 60), (104, None),
            (105, text(8) + "\n" + item), (106, clean[2][1].replace("x", "X", 1) + " end")]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    folder = str(tmp_path)
    spark_.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], schema).write.parquet(f"{folder}/documents.parquet")
    spark_.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    out = {x.doc_id: x for x in corpus_pipeline.run(spark_, folder).collect()}
    assert set(range(20)) <= set(out)                                                   # clean documents stay
    assert not {100, 102, 103, 104, 105} & set(out)
    assert out[101].text.split("\n")[0] not in copied[:4] and out[101].n_chars == len(out[101].text)
    assert all(x.round_trip and x.n_tokens > 0 for x in out.values())
    empty = tmp_path / "none"
    spark_.createDataFrame([], schema).write.parquet(f"{empty}/documents.parquet")
    spark_.createDataFrame([], "item_id long, text string").write.parquet(f"{empty}/benchmark.parquet")
    assert corpus_pipeline.run(spark_, str(empty)).count() == 0


def test_pipeline_stages_with_null_and_repeated_ids(spark_, tmp_path):
    r = random.Random(2)
    text = lambda n: " ".join("".join(r.choice("abcdefghx") for _ in range(6)) for _ in range(n))
    item = " ".join(f"item{i}q" for i in range(30))
    own, twin, held = [text(80) for _ in range(6)], text(300), text(60) + " " + item
    rows = [*[(None, t) for t in own[:3]], (None, own[0]), (7, own[3]), (7, own[4]), (7, own[4]), (9, own[5]), (None, own[5]),
            (3, twin), (9, twin + " end"), (None, held), (8, text(70) + " " + item), (8, text(80))]
    docs = make(spark_, rows)
    kept = Counter((x.doc_id, x.text) for x in corpus_pipeline.near_copies(spark_, docs, "").collect())
    assert kept == Counter({*[(None, t) for t in own[:3]], (7, own[3]), (7, own[4]), (9, own[5]), (3, twin), *rows[11:]})
    spark_.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    left = Counter((x.doc_id, x.text) for x in corpus_pipeline.benchmark_free(spark_, docs, str(tmp_path)).collect())
    assert left == Counter([*rows[:11], rows[13]])
