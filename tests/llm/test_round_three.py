"""Operators 11 to 13: plain versions, odd rows, hot groups."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from odd_rows import LONG, ROWS
from topicloom.llm import merkle, minhash, periods


def rows(df):
    return [r.asDict() for r in df.collect()]


# ------------------------------------------------------------------ 11: Merkle manifest


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row):
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def plain_tree(leaves):
    """(root, for every leaf the siblings level by level with its own position)."""
    paths = [[] for _ in leaves]
    nodes = [(h, [i]) for i, h in enumerate(leaves)]
    while len(nodes) > 1:
        up = []
        for a in range(0, len(nodes), 8):
            run = nodes[a : a + 8]
            for p, (_, below) in enumerate(run):
                for i in below:
                    paths[i].append((p, [h for h, _ in run[:p] + run[p + 1 :]]))
            up.append((sha(*(h for h, _ in run)), [i for _, below in run for i in below]))
        nodes = up
    return nodes[0][0], paths


def plain_manifest(table, shown):
    """{place in table: (leaf, subroot, root, proof, folded)}."""
    groups = {}
    for i, row in enumerate(table):
        groups.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, plain_leaf(row), i))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: plain_tree([x[2] for x in sorted(groups[g])]) for g in names}
    root, above = plain_tree([trees[g][0] for g in names])
    out = {}
    for k, g in enumerate(names):
        for (_, _, leaf, i), path in zip(sorted(groups[g]), trees[g][1]):
            path, h = path + above[k], plain_leaf(shown[i])
            for p, others in path:
                h = sha(*others[:p], h, *others[p:])
            out[i] = (leaf, trees[g][0], root, sha(*(x for _, others in path for x in others)), h)
    return out


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def manifest(spark, table):
    df = spark.createDataFrame(table, SCHEMA).repartition(4)
    changed = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.upper("text")).otherwise(F.col("text"))
    shown = [(*r[:4], r[4].upper() if r[4] and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 else r[4]) for r in table]
    got = merkle.proofs(df, changed)
    want = plain_manifest(table, shown)
    key = lambda r: tuple("" if x is None else str(x) for x in r)
    have = sorted(((r["doc_id"], r["leaf"], r["subroot"], r["root"], r["proof_sha256"], r["folded_root"]) for r in got.collect()), key=key)
    assert have == sorted(((table[i][0], *v) for i, v in want.items()), key=key)
    assert all(r["verified"] == (r["folded_root"] == r["root"]) for r in got.collect())
    return got


def test_addresses_fill_the_tree():
    for levels in range(1, 6):
        places = np.concatenate([merkle.address(levels, d, np.arange(8**d)) for d in range(levels)])
        assert sorted(places.tolist()) == list(range(merkle.tree_size(levels)))
    # Split at half height: the four levels are a pair on top, then eight pairs.
    assert merkle.address(4, 2, 0) == 9 and merkle.address(4, 3, 7) == 17 and merkle.address(4, 2, 3) == 9 + 3 * 9


@pytest.mark.parametrize("sizes", [(1,), (8, 9), (1, 2, 64, 65, 513), (520, 30, 1)])
def test_manifest_equals_plain_trees(spark, sizes):
    rng = random.Random(sum(sizes))
    table = [(rng.randint(0, 10**9), f"s{rng.randint(0, 3)}", f"l{g}", rng.randint(0, 99), f"text é {rng.random()}") for g, n in enumerate(sizes) for _ in range(n)]
    rng.shuffle(table)
    manifest(spark, table)


def test_manifest_of_many_groups_and_odd_rows(spark):
    table = [(i, None, f"g{i:04}", None, "t") for i in range(530)]  # more groups than a block holds
    table += [(None, "s", None, 1, "x"), (None, "s", None, 1, "x"), (5, "", None, 0, ""), (5, None, "", None, None), (5, "s", "é", -1, LONG)]
    manifest(spark, table)


def test_manifest_of_clashing_columns_and_no_rows(spark, odd_docs, no_docs):
    wide = lambda d: d.withColumns({c: F.lit("x") for c in ("grp", "idx", "leaf", "shown", "total", "tie", "part", "at", "id")})
    extra = {"source": F.lit("s"), "n_chars": F.lit(1)}
    assert len(rows(merkle.proofs(wide(odd_docs.withColumns(extra))))) == len(ROWS)
    assert rows(merkle.proofs(wide(no_docs.withColumns(extra)))) == []


# ------------------------------------------------------------------ 12: periodic runs


def plain_runs(w):
    out, n = {}, len(w)
    for q in range(1, n // 3 + 1):
        i = 0
        while i < n - q:
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i < n - q and w[i] == w[i + q]:
                i += 1
            if i - s + q >= max(24, 3 * q):
                out.setdefault((s, i - s + q), q)
    return sorted((s, n, q) for (s, n), q in out.items())


def plain_report(text):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", text or "") if x]
    found = sorted(plain_runs(w), key=lambda r: (r[0], r[2]))
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    top = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None, None, None))
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    return len(found), *top, 1000 * top[1] // top[2] if found else None, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest()


def random_words(rng):
    w, k = [], rng.choice([1, 2, 3, 40])
    for _ in range(rng.randint(0, 6)):
        if rng.random() < 0.5:
            w += [f"v{rng.randrange(k)}" for _ in range(rng.randint(0, 60))]
        else:
            p = [f"v{rng.randrange(k)}" for _ in range(rng.randint(1, rng.choice([3, 10, 60])))]
            w += (p * 12)[: rng.randint(len(p), len(p) * 9)]
    return w


COLUMNS = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def test_runs_equal_plain_search(spark):
    rng = random.Random(7)
    fib, b = ["a"], ["a", "b"]
    while len(b) < 800:
        fib, b = b, b + fib
    texts = {i: rng.choice([" ", "  ", "\t\n"]).join(random_words(rng)) for i in range(400)} | {400: " ".join(b), 401: "z " * 2000, 402: " ".join(["x"] * 90)}
    got = rows(periods.report(spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)))
    assert len(got) == len(texts)
    for r in got:
        assert tuple(r[c] for c in COLUMNS) == plain_report(texts[r["doc_id"]]), texts[r["doc_id"]]


def test_tiles_find_every_run():
    rng = random.Random(11)
    for _ in range(600):
        w = random_words(rng)
        number = {}
        ids = np.array([number.setdefault(x, len(number)) for x in w], np.int32)
        merged = {}
        for octave, lo, bounds, words in periods.tiles(ids):
            for q, a, b in periods.solve(octave, bounds, words.tolist()):
                merged.setdefault(q, set()).update(range(a + lo, b + lo))
        found = []
        for q, places in merged.items():
            for s in sorted(p for p in places if p - 1 not in places):
                e = s
                while e in places:
                    e += 1
                if e - s + q >= max(24, 3 * q):
                    found.append((s, e - s + q, q))
        assert sorted(found) == plain_runs(w)


def test_runs_of_odd_rows(odd_docs, no_docs):
    got = rows(periods.report(odd_docs))
    assert sorted((str(r["doc_id"]), *(str(r[c]) for c in COLUMNS)) for r in got) == sorted((str(i), *map(str, plain_report(t) if t != LONG else plain_long())) for i, t, _ in ROWS)
    assert rows(periods.report(no_docs)) == []


def plain_long():
    kept = "word " + "x" * 50_000
    return 1, 0, 30_000, 1, 30_000_000, hashlib.sha256(b"0,30000,1\n").hexdigest(), hashlib.sha256(kept.encode()).hexdigest()


# ------------------------------------------------------------------ 13: b-bit MinHash


def plain_set(text):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if x]
    n = min(3, len(w))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()


def plain_components(texts):
    sets = {i: plain_set(t) for i, t in texts.items()}
    up = {i: i for i in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_near_copies_equal_all_pairs(spark):
    rng = random.Random(13)
    base = [[f"w{rng.randint(0, 300)}" for _ in range(rng.choice([1, 2, 3, 4, 30, 80, 200]))] for _ in range(10)]
    texts = {}
    for i in range(260):  # half of them from one base: a hot bucket with pairs on both sides of the threshold
        w = list(base[9] if i % 2 else rng.choice(base))
        for _ in range(rng.randint(0, 5)):
            w[rng.randrange(len(w))] = f"v{rng.randint(0, 40)}"
        texts[i] = " ".join(w) if i % 7 else " \n".join(w).upper()
    d = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows(minhash.near_copies(d))}
    assert got == plain_components(texts)


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(0)
    pool = rng.integers(0, 1 << 63, 4000, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    for share in (0.5, 0.85, 0.97):
        found = []
        for _ in range(60):
            n = 600
            shared = int(round(2 * n * share / (1 + share)))
            pick = rng.permutation(pool)
            a, b = np.sort(pick[:n]), np.sort(np.concatenate([pick[:shared], pick[n : 2 * n - shared]]))
            x, y = minhash.packed(minhash.minima(a)), minhash.packed(minhash.minima(b))
            d = x ^ y
            differ = sum(bin(int(v)).count("1") for v in (d | (d >> np.uint64(1))) & np.uint64(0x5555555555555555))
            found.append(((minhash.HASHES - differ) / minhash.HASHES - 0.25) / 0.75)
        assert abs(np.mean(found) - share) < 0.03


def test_near_copies_of_odd_rows(odd_docs, no_docs):
    got = rows(minhash.near_copies(odd_docs))
    want = plain_components(dict(enumerate(t if t != LONG else "word word word word xx" for _, t, _ in ROWS)))
    assert len(got) == len(ROWS) and rows(minhash.near_copies(no_docs)) == []
    by = sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"]), str(r["kept"])) for r in got)
    least = {}
    for n, (i, _, _) in enumerate(ROWS):
        c = want[n][1]
        least[c] = min(least.get(c, i), i) if i is not None and least.get(c, i) is not None else i
    expected = []
    for n, (i, _, _) in enumerate(ROWS):
        c = least[want[n][1]] if i is not None else None
        expected.append((str(i), want[n][0], str(c), str(c == i) if i is not None else "None"))
    assert by == sorted(expected)
