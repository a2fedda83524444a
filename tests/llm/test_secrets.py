import os
import random
import re
import string

import numpy as np
import pytest

from lodestrata.llm import secrets

WORDS = ["the", "tion", "then", "therein", "onward", "identifier", "getValue", "user_name", "reading", "another2"]


def plain_base(text):
    found = [(m.start(), 0, m.end()) for m in re.finditer(r"""(?a:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[1]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found)


def corpus(seed, n=60):
    rng = random.Random(seed)
    chars = string.ascii_letters + string.digits
    key = lambda k: "".join(rng.choice(chars) for _ in range(k))
    out = []
    for i in range(n):
        words = [rng.choice(WORDS) for _ in range(rng.randrange(200))]
        if i % 3 == 0:
            words.insert(len(words) // 2, f'token = "{key(40)}"')
        out.append(" ".join(words))
    return out


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, spans string, n_chars int")


CASES = [
    "token=token= abcdefgh", "Token : 'abcdefghi'", "token == abcdefgh", "API_KEY=\"a/b+c=d_e-f.g\" x", "apikey:1234567", "apikey:12345678", "ſecret=abcdefghi", "toKen=abcdefghi",
    "AKIA" + "A" * 11, "AKIA" + "A" * 12, "xAKIAAKIA" + "B" * 12, "0" * 31, "f" * 32 + "g" + "a" * 40, "é token=secret=abcdefgh", "", "password\n=abcdefgh", "secret='" + "ab12" * 10 + "'",
]


def test_base_matches():
    for text in [*CASES, *corpus(1)]:
        assert secrets.base_spans(text, text.encode()) == plain_base(text), text


def test_markov_spans(spark):
    texts = corpus(2)
    ratios = secrets.train(frame(spark, texts))
    rng = random.Random(5)
    chars = string.ascii_letters + string.digits
    strange = ["".join(rng.choice(chars) for _ in range(36)) + "7" for _ in range(30)]
    plain = ["thetionthen2therein_onward", "identifierGetValue2reading", "reading_another2_user_name"]
    caught = sum(any(k == 3 for _, k, _ in secrets.all_spans(t, t.encode(), ratios)) for t in strange)
    assert caught >= 27
    assert not any(secrets.all_spans(t, t.encode(), ratios) for t in plain)
    text = f"token={strange[0]} and {strange[1]}"
    assert [k for _, k, _ in secrets.all_spans(text, text.encode(), ratios)][0] == 0  # the base span stays


def test_runs_against_the_plain_ratio(spark):
    ratios = secrets.train(frame(spark, corpus(3)))
    rng = random.Random(8)
    text = "".join(rng.choice("abcZ9_-+/= \n.é,日") for _ in range(5000))
    data = text.encode()
    for piece in (1 << 20, 64):
        secrets.PIECE, kept = piece, secrets.PIECE
        want = [m.span() for m in re.finditer(r"[A-Za-z0-9+/_=-]{8,}", text) if secrets.ratio(ratios, m[0]) >= secrets.MARGIN]
        assert secrets.markov_spans(data, ratios) == want and want
        secrets.PIECE = kept


def test_recall_and_precision_on_held_out_and_planted_strings(spark):
    folder = "/root/testdata/sf0.01/documents.parquet"
    if not os.path.exists(folder):
        pytest.skip("needs the test tables")
    docs = spark.read.parquet(folder)
    half = docs.where("crc32(cast(doc_id as string)) % 2 = 0")
    ratios = secrets.train(half)
    own = missed = false = tokens = 0
    for r in docs.where("crc32(cast(doc_id as string)) % 2 = 1").collect():
        data = (r.text or "").encode()
        spans = secrets.base_spans(r.text or "", data)
        for value in secrets._values(r.text or "", spans):
            own += 1
            missed += not secrets.markov_spans(value.encode(), ratios)
        tokens += len(secrets._runs(data, ratios)[0])
        false += len([s for s in secrets.all_spans(r.text or "", data, ratios) if s[1] == 3])
    assert own > 0 and missed == 0 and false <= 1e-4 * tokens
    rng = random.Random(4)
    for chars, n, least in ((string.ascii_letters + string.digits, 12, 0.9), (string.ascii_letters, 16, 0.9), (string.ascii_letters + string.digits, 24, 0.99)):
        made = ["".join(rng.choice(chars) for _ in range(n)) for _ in range(300)]
        assert sum(bool(secrets.markov_spans(x.encode(), ratios)) for x in made) >= least * len(made), (chars, n)


def test_scan_and_redact(spark):
    df = frame(spark, [*CASES, None, "x " * 300_000 + "token=abcdefgh1"])
    ratios = secrets.train(df)
    got = {r.doc_id: [(s.start, secrets.KINDS.index(s.kind), s.end) for s in r.spans] for r in secrets.scan(df, ratios).collect()}
    for i, t in enumerate(CASES):
        assert [s for s in got[i] if s[1] < 3] == plain_base(t)
    assert got[len(CASES)] == [] and got[len(CASES) + 1] == [(600_000, 0, 600_015)]
    out = secrets.redact(df, ratios)
    assert out.schema == df.schema
    rows = {r.doc_id: r for r in out.collect()}
    assert rows[5].text == "[SECRET]" and rows[5].n_chars == 8
    assert rows[4].text == CASES[4] and rows[4].n_chars == 1 and rows[len(CASES)].text is None
    assert rows[13].text == "é [SECRET]"


def test_empty_table(spark):
    df = frame(spark, [])
    ratios = secrets.train(df)
    assert np.isfinite(ratios).all() and secrets.scan(df, ratios).count() == 0 and secrets.redact(df, ratios).count() == 0
