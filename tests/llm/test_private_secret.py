import hashlib
import random
import re
import string

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_tools import documents, odd_rows, sentence
from tidemark.llm import randomness, skip_chain
from tidemark.llm.common import Spans

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(map(int, str(2 * int(d)))) for d in even)) % 10 == 0


def private(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    found = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    found += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    found += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 12 <= len(digits(m)) <= 19 and luhn(digits(m))]
    found += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]
    return sorted(found)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from([*"a.@+-_%1 2(30)é\n", "4111111111111111", "a@b.c", "1.2.3.4", "255", "+1 (2) 345-6789", ".."]), max_size=25).map("".join))
def test_fixed_private_patterns(text):
    assert skip_chain.base_spans(text) == private(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 40), st.integers(0, 3), st.integers(1, 9)), max_size=8), st.integers(0, 40), st.integers(1, 9))
def test_spans_met(rows, start, length):
    spans = [(a, k, a + n) for a, k, n in rows]
    assert Spans(spans).meet(start, start + length) == any(a < start + length and start < b for a, _, b in spans)


ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)


def secret(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from([*"aZ.=:\"' _-9é\n", "token", "SECRET", "api_key", "paſſword", "password", "AKIA", "ABCDEFGH1234", "0123456789abcdef0", "deadbeefdeadbeef"]), max_size=20).map("".join))
def test_fixed_secret_patterns(text):
    assert randomness.base_spans(text) == secret(text)


def digest(spans, kinds):
    return hashlib.sha256(",".join(f"{kinds[k]}:{s}:{e}" for s, k, e in spans).encode()).hexdigest()


def test_private_report_over_odd_rows(spark):
    extra = "Call +1 (988) 555-2485 or a.b@mail.example.com, 10.0.0.1 and 4111 1111 1111 1111."
    rows = [*odd_rows(), (60, extra, None), (61, extra + " again " + extra, None), (62, "9" * 50_000, None), (63, "a" * 100_000 + "@", None)]
    docs = documents(spark, rows)
    got = skip_chain.report(skip_chain.find(docs, skip_chain.fit(docs))).collect()
    expect = sorted((str(i), digest(private(t or ""), skip_chain.KINDS)) for i, t, _ in rows if len(t or "") < 50_000)
    assert sorted((str(r["doc_id"]), r["base_sha256"]) for r in got if r["doc_id"] not in (7, 8, 62, 63)) == [e for e in expect if e[0] not in ("7", "8")]
    row = next(r for r in got if r["doc_id"] == 60)
    assert (row["n_email"], row["n_ip"], row["n_card"], row["n_phone"]) == (1, 1, 1, 1)


def training_texts(rng, n):
    out = []
    for _ in range(n):
        number = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
        things = [f"+1 ({number(3)}) {number(3)}-{number(4)}", f"{sentence(rng, 1)}{number(2)}@mail.example.com", ".".join(str(rng.randrange(256)) for _ in range(4)), f"section {number(1)}.{number(1)}"]
        rng.shuffle(things)
        out.append(" word here, ".join(things[: rng.randrange(1, 5)]))
    return out


def test_field_learns_the_labels():
    rng = random.Random(1)
    examples = []
    for text in training_texts(rng, 400):
        g = skip_chain.graph(text)
        if g is not None:
            examples.append((g, skip_chain.node_labels(g, skip_chain.base_spans(text))))
    field = skip_chain.train(examples[:250])
    right = sum(int((field.marginals(g).argmax(axis=1) == y).sum()) for g, y in examples[250:])
    assert right >= 0.97 * sum(len(y) for _, y in examples[250:])
    # A number written without its country code is found by the field alone, and only there.
    text = "call (988) 555-2485 soon"
    g = skip_chain.graph(text)
    assert [(text[s:e], k) for s, k, e in skip_chain.more_spans(g, field.marginals(g), [])] == [("988) 555-2485", 3)]


def test_messages_give_exact_marginals_on_a_tree():
    import itertools

    rng = np.random.default_rng(2)
    field = skip_chain.Field(rng.normal(size=(skip_chain.N_FEATURES, 5)), rng.normal(size=(5, 5)), rng.normal(size=2))
    g = skip_chain.Graph(np.zeros((4, 2), int), rng.normal(size=(4, skip_chain.N_FEATURES)), np.array([[0, 1]]), np.array([[0, 2]]), np.array([[1, 3]]))
    local, p = g.features @ field.nodes, np.zeros((4, 5))
    for y in itertools.product(range(5), repeat=4):
        w = np.exp(sum(local[i, k] for i, k in enumerate(y)) + field.moves[y[0], y[1]] + field.agree[0] * (y[0] == y[2]) + field.agree[1] * (y[1] == y[3]))
        for i, k in enumerate(y):
            p[i, k] += w
    assert np.allclose(field.marginals(g), p / p.sum(axis=1, keepdims=True), atol=1e-3)


def test_messages_reach_every_repeat_of_a_token():
    """Fifty mentions in a chain of agreement; only the last one is told by its features."""
    rng = np.random.default_rng(4)
    n, agree = 50, 4.0
    field = skip_chain.Field(rng.normal(size=(skip_chain.N_FEATURES, 5)) / 10, np.zeros((5, 5)), np.array([agree, 0.0]))
    features = np.zeros((n, skip_chain.N_FEATURES))
    features[-1] = 40 * rng.normal(size=skip_chain.N_FEATURES)
    g = skip_chain.Graph(np.zeros((n, 2), int), features, np.zeros((0, 2), int), np.stack([np.arange(n - 1), np.arange(1, n)], axis=1), np.zeros((0, 2), int))
    local, pair = np.exp(features @ field.nodes), np.exp(agree * np.eye(5))
    ahead, back = [local[0]], [np.ones(5)]
    for i in range(1, n):
        ahead.append((ahead[-1] @ pair) * local[i])
        ahead[-1] /= ahead[-1].sum()
    for i in range(n - 1, 0, -1):
        back.append(pair @ (back[-1] * local[i]))
        back[-1] /= back[-1].sum()
    exact = np.array(ahead) * np.array(back[::-1])
    exact /= exact.sum(axis=1, keepdims=True)
    found = field.marginals(g)
    assert np.allclose(found, exact, atol=2e-3) and exact[-10].max() > 0.3


def test_random_strings_are_told_from_words():
    rng = random.Random(3)
    letters = string.ascii_letters + string.digits
    strings = ["".join(rng.choice(a) for _ in range(n)) for a in (letters, "0123456789abcdef", string.ascii_uppercase + string.digits) for n in (24, 32, 48) for _ in range(60)]
    words = ["".join(rng.choice(["the", "an", "er", "ing", "tion", "on", "in"]) for _ in range(12))[:n] + str(rng.randrange(10)) for n in (24, 32, 48) for _ in range(60)]
    assert sum(randomness.score(s) > 0.01 for s in strings) >= 0.95 * len(strings)
    assert sum(randomness.score(w) > 0.01 for w in words) <= 0.05 * len(words)


def test_discoveries_keep_the_rate():
    bins = randomness.BINS
    plain = {b: 1000 // (b + 1) for b in range(10)}
    found = randomness.discoveries({bins - 1: 50, 3: 200, bins - 2: 10}, plain, 0.01)
    assert found == {bins - 1, bins - 2}
    assert randomness.discoveries({}, {}, 0.01) == set()


def test_secret_report(spark):
    rng = random.Random(4)
    letters = string.ascii_letters + string.digits
    key = "".join(rng.choice(letters) for _ in range(40)) + "7"
    plain = ["".join(rng.choice(["the", "an", "er", "ing", "tion", "on"]) for _ in range(rng.randrange(10, 30))) for _ in range(3000)]
    rows = [*odd_rows(), *((1000 + i, f"{p} word", None) for i, p in enumerate(plain)), (70, f"key is {key} there", None), (71, "token = 'abcdefgh12' and " + plain[0] + "1", None)]
    found = randomness.find(documents(spark, rows))
    got = {r["doc_id"]: r for r in randomness.report(found, randomness.accepted_places(found)).collect()}
    assert got[70]["spans"] == f"random:7:{7 + len(key)}" and got[70]["n_assign"] == 0
    assert got[71]["n_assign"] == 1 and got[71]["n_random"] == 0 and got[71]["spans"] == "assign:0:19"
    assert got[1]["spans"] == "" and got[8]["spans"] == ""


def test_keys_are_found_however_few_plain_words_share_their_length():
    rng = random.Random(5)
    letters = string.ascii_letters + string.digits
    words = ["page", "green", "mountain", "river", "holiday", "winter", "garden", "letters"]
    slugs = ["-".join(rng.choice(words) for _ in range(12)) for _ in range(400)]
    for length in (20, 28, 36, 50, 70):
        keys = ["".join(rng.choice(letters) for _ in range(length - 1)) + "7" for _ in range(10)]
        dull = [s[: length - 2] + f"-{rng.randrange(10)}" for s in slugs[:200]]
        plain = [s[:length] for s in slugs[200:250]]
        rules = ["-" * length, "_" * length, "-/" * (length // 2)]
        for context in ([], plain[:1], plain, rules, rules * 500, plain + rules * 500):
            candidates, counted = {}, {}
            for text in keys + dull + context:
                _, listed, words_seen = randomness._describe(text)
                for _, _, p in listed:
                    candidates[p] = candidates.get(p, 0) + 1
                for p in words_seen:
                    counted[p] = counted.get(p, 0) + 1
            found = randomness.discoveries(candidates, counted, 0.01)
            assert sum(randomness.place(k) in found for k in keys) >= 8
            assert not any(randomness.place(d) in found for d in dull)


def test_one_planted_key_is_reported_with_0_1_and_50_plain_runs(spark):
    key = "q7Zr2LkX9vTb4WmN8sYc"
    for n in (0, 1, 50):
        rows = [(i, "plainwordsandnothingelse"[:21] + " word", None) for i in range(n)]
        rows += [(900, f"key is {key} there", None), (901, "-" * 22, None)]
        found = randomness.find(documents(spark, rows))
        got = {r["doc_id"]: r for r in randomness.report(found, randomness.accepted_places(found)).collect()}
        assert got[900]["spans"] == f"random:7:{7 + len(key)}" and sum(r["n_random"] for r in got.values()) == 1
