from __future__ import annotations

import hashlib
import zlib

from tidemark.llm.merkle import Merkle, manifest, proofs


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    values = (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def climb(nodes):
    """The root of a run of nodes, and the siblings on the way of each."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k in range(len(paths)):
            run = at[k] // 3 * 3
            paths[k].append((nodes[run : at[k]], nodes[at[k] + 1 : run + 3]))
            at[k] //= 3
        nodes = [h(*nodes[k : k + 3]) for k in range(0, len(nodes), 3)]
    return nodes[0], paths


def plain(rows):
    """What the manifest holds, by plain recursion."""
    by_source = {}
    for r in rows:
        by_source.setdefault(r["source"], []).append(r)
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in order:
        kept = [(r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"]), r) for r in by_source[s]]
        kept.sort(key=lambda x: x[:3])
        trees.append(([x[2] for x in kept], [x[3] for x in kept]))
    climbed = [climb(leaves) for leaves, _ in trees]
    root, over = climb([x[0] for x in climbed])
    out = []
    for (leaves, rows), (subroot, paths), beyond in zip(trees, climbed, over):
        for own, r, path in zip(leaves, rows, paths):
            text, i = r["text"], r["doc_id"]
            if text is not None and i is not None and zlib.crc32(str(i).encode()) % 2 == 0:
                text = text.replace("\n", "")
            a = leaf(r, text)
            for before, after in path + beyond:
                a = h(*before, a, *after)
            proof = h(*[x for before, after in path + beyond for x in before + after])
            out.append((i, own, subroot, root, proof, a, a == root))
    return sorted(out, key=repr)


def got(spark, docs, p=Merkle()):
    made = manifest(spark, docs, p)
    assert made.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted([tuple(r) for r in made.collect()], key=repr)


def test_uneven_sources_and_odd_rows(spark, make_docs, odd_rows):
    rows = [(1000 + k, f"line {k}\nnext\r\n\n{k}", f"s{k % 3}") for k in range(45)]
    rows += [(2000 + k, "one\ntwo", "é") for k in range(10)] + [(3000, "alone\n", "z"), (3001, "x\n", "")]
    docs = make_docs(rows + odd_rows)
    kept = [r.asDict() for r in docs.collect()]
    result = got(spark, docs)
    assert result == plain(kept)
    assert {True, False} == {r[-1] for r in result}


def test_many_bands(spark, make_docs):
    """Blocks of nine leaves, so that a source has several bands and a ragged end."""
    rows = [(k, f"a\n{k}", "hot" if k % 3 else f"s{k}") for k in range(500)]
    docs = make_docs(rows)
    kept = [r.asDict() for r in docs.collect()]
    assert got(spark, docs, Merkle(levels=2)) == plain(kept) == got(spark, docs)


def test_clashing_columns_and_empty_table(spark, make_docs):
    docs = make_docs([(k, f"t{k}\n", "s") for k in range(7)])
    expected = got(spark, docs)
    wide = docs
    for name in ("tree", "lo", "hi", "n", "leaf", "other", "digest", "path", "level", "of", "place", "root", "block"):
        wide = wide.selectExpr("*", f"-1 AS `{name}`")
    assert got(spark, wide) == expected
    assert got(spark, docs.where("false")) == []


def test_paths_prove_membership(spark, make_docs):
    docs = make_docs([(k, f"t{k}", f"s{k % 5}") for k in range(40)])
    for r in proofs(spark, docs).collect():
        a = r.leaf
        for s in r.path:
            a = h(s.before.hex(), a, s.after.hex())
        assert a == r.root
