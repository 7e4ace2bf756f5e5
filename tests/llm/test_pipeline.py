"""``corpus_pipeline.run`` on a small fixture against plain Python: which documents stay, which text
they have, how many words each source gives, and which token ids the sequences hold."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline as P
from cohortlens.llm import toxicity as X
from cohortlens.llm.queries import vocabulary

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def prose(seed, n):
    r = np.random.default_rng(seed)
    return " ".join("".join(r.choice(["la", "to", "men", "si", "ra", "ver"], 1 + r.integers(3))) for _ in range(n))


def fixture():
    rows, labels = [], []
    for i in range(60):  # taught: half of them rude
        rude = i % 2
        rows.append((i, (f"you stupid idiot, get lost number{i} " if rude else f"a kind letter number{i} ") + prose(i, 30), f"s{i % 3}"))
        labels.append((i, rude))
    long = prose(1000, 900).split()
    near = long.copy()
    near[7] = "changed"
    rows += [(100, " ".join(long), "s0"), (101, " ".join(long), "s1"), (102, " ".join(near), None), (103, prose(7, 1500), "s1"),
             (104, "key token = abcdefgh1 end " + prose(8, 60), "s2"), (105, "see AKIA" + "Q7" * 10 + " and " + "0f" * 15 + " " + prose(9, 60), "s2"),
             (106, None, "s0"), (107, "", "s0"), (108, "two words", None)]
    return rows, labels


def redact(text):
    spans = [(m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    spans += [(m.start(), m.end()) for p in ("AKIA[A-Z0-9]{16,}", "[0-9a-f]{24,}") for m in re.finditer(p, text)]
    spans += [(m.start(), m.end()) for m in re.finditer("[A-Za-z0-9+/_=-]{20,}", text) if re.search("[0-9]", m[0]) and re.search("[A-Za-z]", m[0])]
    out, at = "", 0
    for a, b in sorted(spans):
        if a >= at:
            out += text[at:a] + "[SECRET]"
        at = max(at, b)
    return out + text[at:]


def shingles(text):
    w = WORD.findall(text.lower())
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def one_of_each(docs):
    parent = {i: i for i, _, _ in docs}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    sets = {i: shingles(t or "") for i, t, _ in docs}
    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return [d for d in docs if root(d[0]) == d[0]]


def levels(sizes):
    """Targets by source: weights 5, 2, 1 repeating, at most three times a source's size."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), float(sum(sizes.values()))
    while open_:
        share = left / sum(weight[s] for s in open_)
        stopped = {s for s in open_ if share * weight[s] >= 3 * sizes[s]}
        for s in stopped or open_:
            target[s] = 3.0 * sizes[s] if stopped else share * weight[s]
        if not stopped:
            break
        left -= sum(target[s] for s in stopped)
        open_ -= stopped
    return target


@pytest.fixture(scope="module")
def ran(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("sf"))
    rows, labels = fixture()
    spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows],
                          "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, y) for i, y in labels], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {}
    for name, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, folder).cache()
        kept[name] = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    return folder, kept, P.run(spark, folder).collect()


def test_stages_keep_what_plain_python_keeps(spark, ran):
    folder, kept, _ = ran
    rows, labels = fixture()
    docs, marks = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    model = X.train(docs, marks)
    scores = X.sigmoid(np.c_[X.features(model["net"], [(t or "").encode() for _, t, _ in rows]), np.ones(len(rows))] @ model["document"])
    mild = [d for d, s in zip(rows, scores, strict=True) if s < 0.5]
    gone = {d[0] for d in rows} - {d[0] for d in mild}
    assert Counter(kept["toxicity"]) == Counter(mild)
    assert len(gone & {i for i, y in labels if y}) > 25 and not gone & {i for i, y in labels if not y}
    assert Counter(kept["near_dedup"]) == Counter(one_of_each(mild))
    assert not {101, 102} & {d[0] for d in kept["near_dedup"]}
    assert Counter(kept["secret_scan"]) == Counter((i, t and redact(t), s) for i, t, s in one_of_each(mild))


def test_mixing_takes_target_words_of_each_source(ran):
    _, kept, _ = ran
    size, taken = Counter(), Counter()
    own = {}
    for i, t, s in kept["secret_scan"]:
        own[i] = WORD.findall(t or "")
        size[s] += len(own[i])
    times = defaultdict(Counter)
    for i, t, s in kept["mixing"]:
        words = WORD.findall(t)
        taken[s] += len(words)
        times[i].update(words)
        assert t == dict((j, u) for j, u, _ in kept["secret_scan"])[i] or not Counter(words) - Counter(own[i])
    for s, want in levels({s: n for s, n in size.items() if n}).items():
        assert abs(taken[s] - want) <= 1, s
    for i, c in times.items():
        held = Counter(own[i])
        assert all(n <= 3 * held[w] for w, n in c.items())


def test_run_packs_the_ids_of_the_mixed_texts(ran):
    from tokenizers import Tokenizer
    _, kept, pieces = ran
    coder = Tokenizer.from_file(vocabulary())
    want = Counter()
    for i, t, _ in kept["mixing"]:
        want.update([(i, tuple(coder.encode(t, add_special_tokens=False).ids) + (1,))])
    documents = defaultdict(dict)
    for r in pieces:
        ids = tuple(np.frombuffer(r["ids"], "<u4").tolist())
        assert r["length"] == len(ids) <= 2048 and r["offset"] == 0 and len(ids) & (len(ids) - 1) == 0
        documents[r["doc_id"], r["doc_tokens"]].setdefault(r["start"], []).append(ids)
    tokens = Counter()
    for (i, n), parts in documents.items():
        starts = sorted(parts)
        assert sum(len(parts[s][0]) for s in starts) == n
        for copy in range(len(parts[starts[0]])):
            tokens[i, n] += 1
    assert tokens == Counter({k: v for k, v in Counter((i, len(ids)) for (i, ids), c in want.items() for _ in range(c)).items()})
    whole = Counter()
    for (i, n), parts in documents.items():
        if all(len(p) == 1 for p in parts.values()):
            whole[i, sum((parts[s][0] for s in sorted(parts)), ())] += 1
    assert whole and all(want[k] for k in whole)
