import random
import warnings

import numpy as np

from rillstone.llm import abuse


def sample(n, seed):
    rng = random.Random(seed)
    places, things = ["Elmby", "Norwick", "Thale", "Ostrow"], ["bridge", "school", "ferry", "harbour", "road"]
    plain = ["The {t} of {p} was closed in spring.", "We vote on the {t} for {p}.", "Who pays for the {t}?", "The {t} costs 40 crowns, says {p}."]
    bad = {"abuse": ["You are a stinking blorgh, sit down.", "Shut up you filthy blorgh!"], "hate": ["The Zenti are vermin, drive them out of {p}.", "No Zenti blood in {p}, they breed like rats."], "sexual": ["He wants to see her naked on the {t}.", "Undress for me, naked in {p}, he said."]}
    out = []
    for _ in range(n):
        say = lambda s: s.format(t=rng.choice(things), p=rng.choice(places))
        parts = [say(rng.choice(plain)) for _ in range(rng.randrange(2, 8))]
        kind = rng.choice([None, None, *bad])
        if kind:
            parts.insert(rng.randrange(len(parts)), say(rng.choice(bad[kind])))
        out.append((" ".join(parts), {kind} if kind else set()))
    return out


def test_learns_from_documents_and_reads_misspellings():
    m = abuse.fit(sample(300, 1))
    test = sample(200, 2)
    s = m.scores([t for t, _ in test]) > abuse.THRESHOLD
    y = np.array([[k in kinds for k in abuse.KINDS[1:]] for _, kinds in test])
    assert (s == y).mean() > 0.97
    odd = m.scores(["The road was closed. You are a stinking b-l-o-r-g-h, sit down.", "You are a sti​nking blooorgh, sit d0wn."])
    assert (odd[:, 0] > abuse.THRESHOLD).all()
    again = abuse.fit(sample(300, 1))
    assert np.allclose(again.scores([t for t, _ in test]), m.scores([t for t, _ in test]))


def test_plain_spelling():
    assert abuse.plain("P-r-i-c-k") == "prick" and abuse.plain("slllut") == "slut" and abuse.plain("nаked") == "naked" and abuse.plain("p3n15") == "penis" and abuse.plain("1905") == "#"


def test_odd_texts_and_no_labels(spark):
    m = abuse.fit(sample(60, 3))
    long = "The road of Thale was closed. " * 5000
    s = m.scores([None, "", " .,;", long, "\x00 You are a stinking blorgh, sit down."])
    assert s.shape == (5, 3) and (s[:3] == 0).all() and s[4, 0] > s[3, 0]
    assert m.scores([]).shape == (0, 3)
    assert abuse.fit([]) is None and abuse.fit([("x", set())]) is None
    docs = spark.createDataFrame([(1, "s", "You are a stinking blorgh, sit down.", "x"), (1, "s", "You are a stinking blorgh, sit down.", "x"), (2, None, None, "x"), (3, "s", "The road was closed.", "x")], "doc_id long, source string, text string, abuse string")
    scored = abuse.score(docs, m, ["doc_id", "source"])
    assert {tuple(r) for r in abuse.kinds(scored).collect()} == {(1, "abuse")}
    assert {r.source: (r.n_docs, r.n_abuse) for r in abuse.rates(scored).collect()} == {"s": (3, 2), None: (1, 0)}
    assert abuse.kinds(abuse.score(docs, None, ["doc_id"])).count() == 0
    assert abuse.score(docs.limit(0), m, ["doc_id"]).count() == 0


def test_votes(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(1, 8)], "doc_id long, text string")
    votes = [(1, "Abuse"), (1, "abuse"), (1, "none"), (2, "none"), (2, None), (3, "hate"), (3, "none"), (4, "other"), (5, "sexual"), (5, "hate"), (9, "hate"), (6, "NONE ")]
    labels = spark.createDataFrame(votes, "doc_id long, verdict string")
    got = {t: k for t, k in abuse.labelled_texts(docs, labels)}
    assert got == {"text 1": {"abuse"}, "text 2": set(), "text 5": {"hate", "sexual"}, "text 6": set()}


def test_more_positive_documents_than_the_bound(spark):
    texts = [(i, t, k) for i, (t, k) in enumerate(sample(1000, 4))]
    docs = spark.createDataFrame([(i, t) for i, t, _ in texts], "doc_id long, text string")
    labels = spark.createDataFrame([(i, next(iter(k), "none")) for i, _, k in texts], "doc_id long, verdict string")
    n = {k: sum((next(iter(kinds), "none")) == k for _, _, kinds in texts) for k in abuse.KINDS}
    most = 360
    quota = {"none": most // 2} | dict.fromkeys(abuse.KINDS[1:], most // 6)
    assert sum(n[k] for k in abuse.KINDS[1:]) > most and all(n[k] > quota[k] for k in abuse.KINDS)
    got = abuse.labelled_texts(docs, labels, most=most)
    assert len(got) == most and {k: sum(next(iter(kinds), "none") == k for _, kinds in got) for k in abuse.KINDS} == quota
    m = abuse.fit(got)
    assert m is not None
    # the bound does not move the rate at which documents are flagged
    all_of_them = abuse.fit([(t, k) for _, t, k in texts])
    test = [t for t, _ in sample(300, 5)]
    rate = lambda x: (x.scores(test) > abuse.THRESHOLD).any(axis=1).mean()
    assert abs(rate(m) - rate(all_of_them)) < 0.03
    assert {r.kind for r in abuse.kinds(abuse.score(docs, m, ["doc_id"])).collect()} == set(abuse.KINDS[1:])
    # what a kind leaves unused goes to the others
    few = labels.where("verdict <> 'hate' or doc_id < 40")
    left = sum(1 for i, _, k in texts if k == {"hate"} and i < 40)
    got = abuse.labelled_texts(docs, few, most=most)
    parts = {k: sum(next(iter(kinds), "none") == k for _, kinds in got) for k in abuse.KINDS}
    assert len(got) == most and parts["hate"] == left < most // 6 and abs(parts["abuse"] - parts["sexual"]) <= 1 and abs(parts["none"] - 3 * parts["abuse"]) <= 3


def test_slips_of_reviewers_do_not_spread():
    data = sample(400, 6)
    rng = random.Random(7)
    odd = [(t, {rng.choice(abuse.KINDS[1:])} if not k and rng.random() < 0.08 else k) for t, k in data]
    m = abuse.fit(odd)
    test = sample(300, 8)
    s = m.scores([t for t, _ in test]) > abuse.THRESHOLD
    y = np.array([[k in kinds for k in abuse.KINDS[1:]] for _, kinds in test])
    assert (s & ~y).any(axis=1).mean() < 0.02 and s[y].mean() > 0.95


def test_no_clean_documents_is_said(spark):
    with warnings.catch_warnings(record=True) as said:
        warnings.simplefilter("always")
        assert abuse.fit([("You are a blorgh.", {"abuse"})] * 20) is None
    assert any("no classifier" in str(w.message) for w in said)
    docs = spark.createDataFrame([(1, "s", "text")], "doc_id long, source string, text string")
    scored = abuse.score(docs, None, ["doc_id", "source"])
    assert scored.first().abuse is None and abuse.kinds(scored).count() == 0 and abuse.rates(scored).first().n_abuse is None
