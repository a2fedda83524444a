import random

import pytest

from lodestrata.llm import suffixes


def brute(rows, length):
    seen, out = set(), []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or b"")):
        t = t or b""
        gone = bytearray(len(t))
        for s in range(len(t) - length + 1):
            if t[s : s + length] in seen:
                gone[s : s + length] = b"\1" * length
            seen.add(t[s : s + length])
        edges = [k for k in range(len(t) + 1) if (gone[k - 1] if k else 0) != (gone[k] if k < len(t) else 0)]
        out.append((i, len(t), list(zip(edges[::2], edges[1::2], strict=True)), bytes(b for b, g in zip(t, gone, strict=True) if not g)))
    return sorted(out, key=str)


def run(spark, rows, length, **options):
    df = spark.createDataFrame([(i, bytearray(t) if t is not None else None, "x") for i, t in rows], "doc_id long, text binary, t string")
    found = suffixes.remove_repeats(df, length, **options).collect()
    return sorted(((r.doc_id, r.n_bytes, [(s.start, s.end) for s in r.spans], bytes(r.kept)) for r in found), key=str)


@pytest.mark.parametrize(("length", "gram", "letters", "crowd"), [(20, 6, 4, 50_000), (20, 6, 4, 5), (12, 4, 2, 50_000), (12, 4, 2, 5), (100, 24, 26, 50_000)])
def test_against_brute_force(spark, length, gram, letters, crowd):
    rng = random.Random(length + letters)
    word = lambda n: bytes(97 + rng.randrange(letters) for _ in range(n))
    base = word(600)
    rows = []
    for i in range(50):
        parts = []
        for _ in range(rng.randrange(5)):
            at = rng.randrange(600)
            parts += [base[at : at + rng.randrange(5, 200)], word(rng.randrange(30))]
        rows.append((i, b"".join(parts)))
    # Repeated rows, periodic texts, bytes of all values, nulls, short and empty texts.
    rows += [(60, b"a" * 300), (61, b"ab" * 200), (62, bytes(range(256)) * 2), (60, b"a" * 300), (60, b"a" * 150), (None, base), (None, b"ab" * 90), (63, None), (64, b""), (65, b"x" * (length - 1)), (66, rows[3][1]), (5, b"xyz" * 99)]
    assert run(spark, rows, length, gram=gram, crowd=crowd) == brute(rows, length)


def test_long_text_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "PIECE", 500)
    rng = random.Random(1)
    text = bytes(97 + rng.randrange(3) for _ in range(3000))
    rows = [(1, text + text[100:900]), (2, text[700:1900])]
    assert [sorted(zip(*(c.tolist() for c in suffixes.find_anchors([t], 30, 8)[1:]), strict=True)) != [] for _, t in rows] == [True, True]
    assert run(spark, rows, 30, gram=8) == brute(rows, 30)


@pytest.mark.parametrize("named", [1 << 20, 0])
def test_crowds_are_dealt_out(spark, monkeypatch, named):
    """A k-gram in most texts: found before the shuffle, its rows in several partitions, the result the same."""
    monkeypatch.setattr(suffixes, "LOCAL", 2)
    monkeypatch.setattr(suffixes, "SEGMENT", 300)
    monkeypatch.setattr(suffixes, "NAMED", named)
    rng = random.Random(3)
    word = lambda n: bytes(97 + rng.randrange(26) for _ in range(n))
    passage = word(80)
    rows = [(i, word(20 + i) + (passage if i % 4 else passage[5:70]) + word(30)) for i in range(120)]
    rows += [(i, word(200)) for i in range(120, 160)] + [(None, passage), (7, None), (8, b"")]
    texts = suffixes._numbered(spark.createDataFrame([(i, t) for i, t in rows], "doc_id long, text binary"), "doc_id", "text")
    anchors = {}
    for i, t in enumerate(t or b"" for _, t in rows):
        for h in set(suffixes.find_anchors([t], 30, 8)[1].tolist()):
            anchors.setdefault(h, set()).add(i)
    found = {r.h for r in suffixes._crowd_grams(texts, 30, 8, 40).collect()}
    assert found == {h for h, of in anchors.items() if len(of) > 40} and found
    marked = suffixes._repeated_anchors(texts, 30, 8, 40).collect()
    assert {x.h for r in marked for x in r.busy} == found and not {x.h for r in marked for x in r.calm} & found
    assert run(spark, rows, 30, gram=8, crowd=40) == brute(rows, 30)


def test_empty_table(spark):
    assert run(spark, [], 100) == []


def test_parameters(spark):
    with pytest.raises(ValueError):
        run(spark, [], 100, gram=100)
