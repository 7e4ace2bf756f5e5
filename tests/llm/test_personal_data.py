"""Personal data: rules against the stated patterns, the network on held-out rows."""

import hashlib
import random
import re
import time

import numpy as np
import pytest

from cohortlens.llm import personal_data as P

SF = "/root/testdata/sf0.01"
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def stated(text):
    """The base spans as stated: each pattern's leftmost matches, failing ones dropped."""
    out = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card":
                total = sum(sum(divmod(2 * int(d), 10)) if i % 2 else int(d) for i, d in enumerate(digits[::-1]))
                if not 16 <= len(digits) <= 19 or total % 10:
                    continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append((k, m.start(), m.end()))
    return sorted(out)


CASES = ["", "a@b.c_d@e.f", "x@a.b-c@d.e", "a@b@c.d", "@b.c", "a@b", "..a@-.-", "1.2.3.4.5.6.7.8", "256.1.1.1", "1.1.1.256 0001.002.3.4",
         "4111111111111111", "4111 1111-1111 1111", "4111  1111 1111 1111", "+1 (208) 555-1177 428489660", "+1", "+12", "+1234567 8-",
         "++49 30 1234567", "é@ü.de a.b+c%d@é.com", "4665471787434696 86.227.24.1", "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6", "a@b.c." * 3]


def test_rules_are_the_stated_patterns():
    r = random.Random(5)
    for text in CASES:
        assert P.rule_spans(text) == stated(text), text
    for _ in range(4000):
        text = "".join(r.choice("01259.@+ -()ab_é\n") for _ in range(r.randrange(60)))
        assert P.rule_spans(text) == stated(text), text
    numbers = ["4111111111111111", "5500 0000 0000 0004", "10.0.0.255", "300.1.1.1", "+49 (30) 123-4567", "jo.e@ex-a.org", "12-34", ".", "-", " "]
    for _ in range(3000):
        text = "".join(r.choice([*numbers, " ", "x", "@"]) for _ in range(r.randrange(8)))
        assert P.rule_spans(text) == stated(text), text


@pytest.mark.parametrize("unit", ["a", "1", "1.", "a.", "+1", "@", "a@", "1 ", "a@b."])
def test_rules_take_time_in_proportion(unit):
    def seconds(n):
        t = time.perf_counter()
        P.rule_spans(unit * n)
        return time.perf_counter() - t
    seconds(1000)
    assert seconds(400_000) < 2


def test_every_character_counts_in_one_window():
    for n in (1, 2, 255, 256, 257, 479, 480, 481, 5000):
        sym = P.Symbols(["x", "y" * n])
        text, number = sym.windows()
        owned = np.zeros(n, int)
        for w in number[text == 1]:
            start = w * P.STRIDE
            low, high = (0 if not start else P.MARGIN), (n - start if start + P.WINDOW >= n else P.WINDOW - P.MARGIN)
            assert 0 <= low < high <= P.WINDOW
            owned[start + low:start + high] += 1
        assert (owned == 1).all()


def test_gradients_by_differences():
    r = np.random.default_rng(0)
    m = P.Tagger.fresh()
    for w in m.weights():
        w += r.normal(0, 0.1, w.shape).astype(np.float32)
    m = P.Tagger(m.embed.astype(float), [g.astype(float) for g in m.gates], *(w.astype(float) for w in (m.out, m.step, m.edge)))
    x, y = r.integers(0, P.PAD + 1, (20, 3)), r.integers(0, P.TAGS, (20, 3))
    _, grads = P.loss_gradients(m, x, y)
    for w, g in zip(m.weights(), grads, strict=True):
        i = np.unravel_index(np.abs(g).argmax(), w.shape)
        old = w[i]
        w[i] = old + 1e-3
        up, _ = P.loss_gradients(m, x, y)
        w[i] = old - 1e-3
        down, _ = P.loss_gradients(m, x, y)
        w[i] = old
        assert (up - down) / 2e-3 == pytest.approx(g[i], rel=2e-2, abs=1e-4)


def test_decoding_is_the_best_path():
    from itertools import product
    r = np.random.default_rng(1)
    m = P.Tagger.fresh()
    m.step += r.normal(0, 1, m.step.shape).astype(np.float32)
    m.edge += r.normal(0, 1, m.edge.shape).astype(np.float32)
    for lead in (0, 3, 30):  # with a large lead of "none" the search is left out
        em = r.normal(0, 1, (5, P.TAGS, 4)).astype(np.float32)
        em[:, 0] += lead
        got = m.decode(em)
        for n in range(4):
            def worth(p, n=n, em=em):
                return (m.edge[0][p[0]] + m.edge[1][p[-1]] + sum(em[t, p[t], n] for t in range(5))
                        + sum(m.step[a, b] for a, b in zip(p, p[1:])))
            assert tuple(got[:, n]) == max(product(range(P.TAGS), repeat=5), key=worth)


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return P.train(docs.where("doc_id % 5 <> 0"))


def test_the_network_finds_spans_of_held_out_documents(spark, model):
    texts = [r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").where("doc_id % 5 = 0").collect()]
    found = P.model_spans(model, texts)
    rules = {(i, *s) for i, t in enumerate(texts) for s in P.rule_spans(t)}
    decoded = {(i, *s) for i, ss in found.items() for s in ss}
    near = sum(any(i == j and k == q and a < f and e < b for j, q, e, f in decoded) for i, k, a, b in rules)
    assert len(rules) > 8 and near / len(rules) > 0.85
    clean = [i for i, t in enumerate(texts) if not P.rule_spans(t)]
    added = sum(bool(P.added_spans(texts[i], [], found.get(i, []))) for i in clean)
    assert added / len(clean) < 0.01


def test_a_card_that_runs_into_an_address_is_added(model):
    text = "The card was 4665471787434696 86.227.24.7 and so on, in the text of the letter."
    rules = P.rule_spans(text)
    assert [k for k, _, _ in rules] == [1]
    more = P.added_spans(text, rules, [(2, 13, 30)])
    assert more == [(2, 13, 29)]


def test_digest_keeps_rule_spans(spark, docs, empty, frame, model):
    got = P.personal_digest(P.find_personal_data(docs, model)).collect()
    assert len(got) == docs.count()
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    odd = frame([(1, "me@here.org and 10.1.2.3"), (2, None), (None, "+49 30 1234567"), (2, "x" * 3_000_000 + " a@b.cd")])
    rows = {(r["doc_id"], r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]): r for r in P.personal_digest(
        P.find_personal_data(odd, None)).collect()}
    assert set(rows) == {(1, 1, 1, 0, 0), (2, 0, 0, 0, 0), (None, 0, 0, 0, 1), (2, 1, 0, 0, 0)}
    assert rows[(1, 1, 1, 0, 0)]["spans"] == "email:0:11,ip:16:24"
    assert rows[(2, 1, 0, 0, 0)]["spans"] == "email:3000001:3000007"
    for r in got + list(rows.values()):
        if r["doc_id"] in text and r in got:
            base = ",".join(f"{P.KINDS[k]}:{a}:{b}" for k, a, b in P.rule_spans(text[r["doc_id"]] or "")) if r["doc_id"] else None
            if base is not None:
                assert r["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
    assert P.find_personal_data(empty, model).collect() == []


def test_without_labelled_spans_there_is_no_model(empty, frame):
    assert P.train(empty) is None and P.train(frame([(1, "no data here"), (2, None)])) is None
