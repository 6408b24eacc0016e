import random

import duckdb
import pytest
import xxhash

from grainmill.llm.components import components, join_dealt
from grainmill.llm.simhash import fingerprint, links, near_duplicates


def plain_fingerprint(text, width=4):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", lowered) if w]
    runs = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(n, pairs):
    up = list(range(n))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in pairs:
        a, b = sorted((top(a), top(b)))
        up[b] = a
    return [top(i) for i in range(n)]


def test_fingerprint_is_the_plain_one():
    texts = ["", None, " \t\n", "one", "One TWO three", "a b c d", "É È\x0bfoo bar baz", "x " * 500, "a\x1cb c\x85d e f g"]
    texts += [" ".join(random.Random(i).choices("aä bc def".split(), k=i * 7)) for i in range(40)]
    for text in texts:
        assert fingerprint(text) == plain_fingerprint(text), text


@pytest.mark.parametrize("distance,crowd", [(4, 64), (4, 1), (2, 3)])
def test_links_reach_what_all_pairs_reach(frame, distance, crowd):
    rng = random.Random(7)
    words = [rng.getrandbits(64) for _ in range(60)]
    for centre in words[:6]:  # chains and balls around some centres, with differences in either half
        for _ in range(40):
            x = centre
            for bit in rng.sample(range(64), rng.randint(0, 7)):
                x ^= 1 << bit
            words.append(x)
    words = sorted(set(words))
    signed = [w - (1 << 64) if w >> 63 else w for w in words]
    pairs = [(i, j) for i in range(len(words)) for j in range(i) if (words[i] ^ words[j]).bit_count() <= distance]
    want = roots(len(words), pairs)
    found = components(links(frame([(w,) for w in signed], "fp long"), distance, crowd)).collect()
    group = {r["node"]: r["root"] for r in found}
    assert len(group) == len(found)
    got = [group.get(w, w) for w in signed]
    assert [[got[i] == got[j] for j in range(i)] for i in range(len(got))] == [[want[i] == want[j] for j in range(i)] for i in range(len(got))]


def test_odd_distance_is_refused(frame):
    with pytest.raises(ValueError):
        links(frame([(1,)], "fp long"), 3)


def test_components_of_long_chains_stars_and_loops(frame):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, x) for x in range(1000, 1100)] + [(5, 5), (1050, 3), (3, 1050)]
    found = {r["node"]: r["root"] for r in components(frame(edges, "a long, b long")).collect()}
    assert {found[i] for i in range(100, 161)} == {100}
    assert {found[i] for i in range(1000, 1100)} == {3} == {found[7]}
    assert 5 not in found
    assert components(frame([], "a long, b long")).count() == 0


def test_documents_with_nulls_repeats_and_clashing_columns(frame):
    base = " ".join(f"w{i}" for i in range(400))
    rows = [(3, base, "x"), (9, base, None), (9, base, None), (4, None, "y"), (8, "", "z"), (None, base, "q"), (5, "alone here", "r")]
    rows += [(20, base.replace("w399", "other"), "s"), (None, "only null id", "t")]
    got = near_duplicates(frame(rows, "doc_id long, text string, fp string")).collect()
    assert len(got) == len(rows)
    by = {(r["id"], r["component_id"]) for r in got}
    assert by == {(3, 3), (9, 3), (None, 3), (20, 3), (4, 4), (8, 4), (5, 5), (None, None)}
    assert near_duplicates(frame([], "doc_id long, text string")).count() == 0


def test_query_on_a_whole_table(spark):
    from grainmill.llm.catalog import QUERIES

    folder = "/root/testdata/sf0.001"
    docs = duckdb.sql(f"select doc_id, text from '{folder}/documents.parquet' order by 1").fetchall()
    prints = [plain_fingerprint(t) for _, t in docs]
    pairs = [(i, j) for i in range(len(docs)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    want = sorted((d, f"{p:016x}", docs[r][0]) for (d, _), p, r in zip(docs, prints, roots(len(docs), pairs)))
    assert sorted(map(tuple, QUERIES["op10_simhash"](spark, folder).collect())) == want


def test_components_of_stars_and_chains(frame):
    """Stars of many rows beside chains, a loop and a null end."""
    edges = [(1000, i) for i in range(200)] + [(i, i + 1) for i in range(2000, 2030)] + [(199, 2030), (5000, 5001), (7000, 7000), (None, 3)]
    found = {r["node"]: r["root"] for r in components(frame(edges, "a long, b long")).collect()}
    first = {1000, *range(200), *range(2000, 2031)}
    assert found == {**{n: 0 for n in first}, 5000: 5000, 5001: 5000}


@pytest.mark.parametrize("share", [0.0, 0.4, 1.0])
def test_rows_of_hot_keys_are_dealt_over_parts(frame, share):
    """The same rows as of a plain join, repeats and missing keys included, whatever one key holds."""
    n = 1200
    rows = [(7 if i < n * share else i, i // 2) for i in range(n)] + [(None, 1), (-5, 1), (-5, 1)]
    side = [(k, k * 10) for k in {r[0] for r in rows if r[0] is not None} if k % 11]
    left, right = frame(rows, "u long, v long"), frame(side, "u long, m long")
    dealt = join_dealt(left, right, "u", n)
    assert sorted(map(tuple, dealt.collect())) == sorted(map(tuple, left.join(right, "u").collect()))
    assert dealt.columns == ["u", "v", "m"]
    plan = dealt._jdf.queryExecution().optimizedPlan().toString()
    joins = [x for x in plan.splitlines() if "Join Inner" in x]
    assert ("(part#" in joins[0]) == (share > 0)  # the part stays a key of the join
