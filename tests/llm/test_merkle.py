import hashlib
import zlib

import pytest

from clickweave.llm import merkle as M

SCHEMA = "id bigint, tree string, leaf string, check string"


def _h(x):
    return hashlib.sha256(x.encode()).hexdigest()


def _grow(nodes, fanout):
    """(levels of nodes, per leaf [(before, after)])."""
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([_h("".join(out[-1][i : i + fanout])) for i in range(0, len(out[-1]), fanout)])
    ways = []
    for i in range(len(nodes)):
        way = []
        for level in out[:-1]:
            start = i - i % fanout
            way.append(("".join(level[start:i]), "".join(level[i + 1 : start + fanout])))
            i //= fanout
        ways.append(way)
    return out[-1][0], ways


def _brute(rows, fanout):
    trees = {}
    for r in rows:
        trees.setdefault(r[1], []).append(r)
    names = sorted(trees, key=lambda t: (t is not None, (t or "").encode()))
    grown = []
    for t in names:
        members = sorted(trees[t], key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
        grown.append((members, *_grow([r[2] for r in members], fanout)))
    root, tops = _grow([g[1] for g in grown], fanout)
    out = []
    for t, (members, subroot, ways), top in zip(names, grown, tops, strict=True):
        for pos, (r, way) in enumerate(zip(members, ways, strict=True)):
            x = r[3] or r[2]
            for before, after in way + top:
                x = _h(before + x + after)
            proof = _h("".join(a + b for a, b in way + top))
            out.append((r[0], t, pos, r[2], subroot, root, proof, x, x == root))
    return sorted(out, key=repr)


def _rows(sizes):
    out = []
    for t, n in sizes.items():
        for i in range(n):
            leaf = _h(f"{t} {i}")
            out.append((1000 * len(out) % 7919, t, leaf, (_h("other"), leaf, None)[i % 3]))
    return out + [(5, "a", _h("x"), None), (5, "a", _h("y"), None), (5, "a", _h("y"), None), (None, "a", _h("z"), None)]


@pytest.mark.parametrize("fanout,local", [(2, 1), (3, 2), (4, 1), (16, 3)])
def test_against_brute_force(spark, fanout, local):
    """Trees of one leaf, of whole and ragged runs, and of more partitions than a round joins."""
    rows = _rows({None: 1, "": 2, "a": 97, "b": 16, "é": 17, "Z": 3, "one": 1, "deep": 65})
    got = M.manifest(spark.createDataFrame(rows, SCHEMA), fanout=fanout, local=local)
    assert sorted(map(tuple, got.collect()), key=repr) == _brute(rows, fanout)


def test_paths_fold_to_the_root(spark):
    rows = _rows({"a": 40, "b": 5})
    got = M.manifest(spark.createDataFrame(rows, SCHEMA).drop("check"), fanout=4, local=1, with_path=True).collect()
    assert {M.fold(r["leaf"], [(s["before"], s["after"]) for s in r["path"]]) for r in got} == {got[0]["root"]}
    assert all(r["verified"] for r in got) and len(got) == len(rows)


def test_every_partition_meets_its_run(spark):
    """Rounds join as many partitions as a run has, also beside an incomplete last subtree."""
    for blocks in (1, 2, 5, 16, 17, 33):
        parts = spark.createDataFrame([("t", i, blocks, _h(str(i))) for i in range(blocks)], "tree string, block bigint, blocks bigint, digest string")
        got = M.butterfly(parts, 4).orderBy("block").collect()
        root, ways = _grow([_h(str(i)) for i in range(blocks)], 4)
        assert [r["digest"] for r in got] == [root] * blocks
        assert [[tuple(s) for s in r["path"]] for r in got] == ways


def test_documents(spark, documents):
    rows = [(i, t, s) for i, (t, s) in enumerate([("A b", "x"), (None, "x"), ("", None), ("é", "x"), ("Q" * 70000, ""), ("none", "x")] * 4)] + [(None, "A", "x"), (2, "", None)]
    got = M.document_leaves(documents(rows)).collect()

    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def leaf(i, t, s, n):
        return _h("".join(map(field, (i, s, "en", n, t))))

    low = lambda t: t and "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
    want = []
    for i, t, s in rows:
        n = None if t is None else len(t)
        picked = i is not None and zlib.crc32(str(i).encode()) % 5 == 0
        want.append((i, s, leaf(i, t, s, n), leaf(i, low(t), s, n) if picked else None))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    found = M.manifest(M.document_leaves(documents(rows))).collect()
    changed = {w[0] for w in want if w[3] not in (None, w[2])}
    assert {r["id"] for r in found if not r["verified"]} == changed and len(found) == len(rows)
    assert M.manifest(M.document_leaves(documents([]))).count() == 0
