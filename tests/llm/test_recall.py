"""Near-duplicate links of a whole table against brute force: the share that banding finds."""

import re
from collections import Counter, defaultdict
from itertools import combinations
from pathlib import Path

import pytest

from cohortlens.llm.near_duplicates import near_duplicates

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.skipif(not Path(SF).exists(), reason="driver tables not present")
def test_no_link_of_a_whole_table_is_lost(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sets = {}
    for r in docs.select("doc_id", "text").collect():
        w = [x.translate({i: i + 32 for i in range(65, 91)}) for x in WORD.findall(r["text"] or "")]
        sets[r["doc_id"]] = {tuple(w[i:i + 4]) for i in range(len(w) - 3)} or ({tuple(w)} if w else set())
    holders = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            holders[g].append(i)
    shared = Counter(p for ids in holders.values() for p in combinations(sorted(ids), 2))
    links = [(a, b) for (a, b), n in shared.items() if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n)]
    got = {r["doc_id"]: r for r in near_duplicates(docs, 4, 80).collect()}
    found = sum(got[a]["component_id"] == got[b]["component_id"] for a, b in links)
    assert len(links) > 50 and found == len(links)
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for a, b in links:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    assert {i: got[i]["component_id"] for i in sets} == {i: root(i) for i in sets}
    assert all(got[i]["n_shingles"] == len(s) for i, s in sets.items())
