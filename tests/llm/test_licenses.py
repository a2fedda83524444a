import random

from lodestrata.llm import licenses as L


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_alignment_is_increasing_and_true():
    rng = random.Random(1)
    for _ in range(200):
        a, b = ([bytes([97 + rng.randrange(9)]) for _ in range(rng.randrange(20))] for _ in range(2))
        pairs = L.patience(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:], strict=False))
        assert len(pairs) <= lcs(a, b)
    text = [b"x%d" % i for i in range(50)]
    assert len(L.patience(text, text)) == 50
    assert len(L.patience([b"q"] * 3 + text[:20] + [b"z"] + text[20:], text)) == 50


def names(text):
    return [m[0] for m in L.Scanner().scan(text.encode())]


def test_scanner():
    assert names("Foo bar.\nReleased under the MIT License.\nMore") == ["MIT"]
    assert names("released UNDER the mit license. released under the MIT License.") == ["MIT", "MIT"]
    assert names(L.TEMPLATES["MIT-terms"].replace("free of charge", "without charge")) == ["MIT-terms"]
    assert "Apache-2.0-header" in names("// " + L.TEMPLATES["Apache-2.0-header"].replace(" ", "\n// "))
    assert names("the license under which it was released by MIT") == [] and names("") == []
    name, coverage, start, end = L.Scanner().scan("é Licensed under CC BY-NC 4.0.".encode())[0]
    assert name == "CC-BY-NC-4.0" and coverage == 1.0 and "é Licensed under CC BY-NC 4.0.".encode()[start:end] == b"Licensed under CC BY-NC 4.0"
    assert names("word " * 100_000 + "Released under the MIT License.") == ["MIT"]


def plain_overlap(words, template, span):
    def at(i):
        left, n = list(template), 0
        for w in words[i : i + span]:
            if w in left:
                left.remove(w)
                n += 1
        return n

    return [at(i) for i in range(len(words))]


def test_overlaps_against_plain_counts():
    rng = random.Random(3)
    for _ in range(100):
        template = [rng.choice(b"abcde") for _ in range(rng.randrange(1, 9))]
        words = [rng.choice(b"abcdefg") for _ in range(rng.randrange(30))]
        assert L.Scanner._overlaps(words, L.Counter(template), len(template) + 2) == plain_overlap(words, template, len(template) + 2)


def test_planted_copies_are_all_found(spark):
    """Copies with words changed, dropped and put in, at known places among common English words, in one text and over rows."""
    rng = random.Random(11)
    filler = "the of and to in is was for on as with that this it by not be are from or software any use license".split()
    scanner = L.Scanner()
    rows, want = [], {}
    for doc in range(40):
        text, planted = [], []
        for name in rng.sample(sorted(L.TEMPLATES), rng.randrange(4)):
            text += [rng.choice(filler) for _ in range(rng.randrange(200))]
            words = L.TEMPLATES[name].split()
            if len(words) >= 40:  # a twentieth of the words of a long text are harmed
                words = [w for w in (rng.choice([w] * 57 + ["", "other", w + " more"]) for w in words) if w]
            planted += [name] * 2
            text += words + ["and", "again", "in", "full"] + words  # twice, one soon after the other
        text += [rng.choice(filler) for _ in range(rng.randrange(100))]
        rows.append((doc, " ".join(text)))
        want[doc] = planted
    found = {r.doc_id: [m.license for m in r.matches] for r in L.scan(spark.createDataFrame(rows, "doc_id long, text string"), L.TEMPLATES).collect()}
    for doc, planted in want.items():
        for name in set(planted):
            assert found[doc].count(name) >= planted.count(name), (doc, name)
        related = {"Apache-2.0": "Apache", "BSD": "BSD", "ISC": "0BSD ISC", "MIT-terms": "MIT BSL"}
        for name in set(found[doc]) - set(planted):  # nothing else, but for what a planted text contains
            assert any(n.split("-")[0] in related.get(name, name) or name.split("-")[0] == n.split("-")[0] for n in planted), (doc, name)
    assert scanner.scan(" ".join(rng.choice(filler) for _ in range(20_000)).encode()) == []


def test_a_copy_before_another_is_found():
    assert names("See the notes. Released under the MIT License. Released under the MIT License.") == ["MIT", "MIT"]
    assert names("Licensed under the Foo License, Version 2.0.") == [] and names("Released under the BSD License.") == []
    assert names("Released here under the MIT License.") == ["MIT"]


def test_rows(spark):
    rows = [(1, "Released under the MIT License.", "x"), (2, None, "x"), (None, "", "x"), (3, "none", "x"), (1, "Released under the MIT License.", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, matches string")
    got = sorted(((r.doc_id, [m.license for m in r.matches]) for r in L.scan(df).collect()), key=str)
    assert got == sorted([(1, ["MIT"]), (1, ["MIT"]), (2, []), (None, []), (3, [])], key=str)
    assert L.scan(df.limit(0)).count() == 0
