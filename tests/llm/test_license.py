import re
import textwrap

from moodlens.llm import license_scan as L


def _dice(a, b):
    a, b = set(L._bigrams(a)), set(L._bigrams(b))
    return 2 * len(a & b) / (len(a) + len(b)) if a or b else 0.0


def test_brute_force(table):
    texts = [None, "", "x", "Released under the\nMIT License!", "ALL RIGHTS RESERVED", "all rights reserved all rights reserved", L.TEMPLATES[4][1].upper(), "\n".join(L.TEMPLATES[1][1].split(", ")), "Licensed under CC BY-NC 4.0.\nfoo\nLicensed under CC BY 4.0", "a b " * 4000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "All rights reserved.")]
    want = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        for unit, part in [*([(0, text)] if len(lines) > 1 else []), *enumerate(lines, 1)]:
            for i, (_, body) in enumerate(L.TEMPLATES):
                if _dice(part, body) >= L.THRESHOLD:
                    want.append((doc if doc is not None else 99, unit, i, round(_dice(part, body), 9)))
    got = [(r.doc_id if r.doc_id is not None else 99, r.unit, r.template, round(r.dice, 9)) for r in L.license_scan(table(rows)).collect()]
    assert sorted(got) == sorted(want) and len(want) > 8
    assert L.license_scan(table(rows).limit(0)).count() == 0


def test_repeated_rows_match_each(table):
    assert L.license_scan(table([(1, "All rights reserved.")] * 2)).count() == 2


def _words(text):
    return re.sub("[^a-z0-9]+", " ", text.lower()).split()


def _runs(text):
    """Runs of words that match, and lie in no unit that matches the same licence."""
    out, words = [], _words(text)
    pairs = [f"{a} {b}" for a, b in zip(words, words[1:])]
    line_of = [i for i, line in enumerate(text.split("\n")) for _ in _words(line)]
    for i, (name, body) in enumerate(L.TEMPLATES):
        known, most = set(L._bigrams(body)), int((len(_words(body)) - 1) * 1.5)
        like = [x for other, x in L.TEMPLATES if other == name]
        hits, found = [k for k, p in enumerate(pairs) if p in known], []
        for a in hits:
            ends = [(-2 * len(own & known) / (len(own) + len(known)), a, b) for b in hits if a <= b < a + most for own in [set(pairs[a : b + 1])]]
            found += [x for x in ends if -x[0] >= L.THRESHOLD]
        taken = []
        for x in sorted(found):
            if not any(x[1] <= y[2] + 1 and y[1] <= x[2] + 1 for y in taken):
                taken.append(x)
        for dice, a, b in taken:
            units = [text] + ([text.split("\n")[line_of[a]]] if line_of[a] == line_of[b + 1] else [])
            if not any(_dice(u, x) >= L.THRESHOLD for u in units for x in like):
                out.append((-a - 1, i, round(-dice, 9)))
    return sorted(out)


def test_parts_of_lines_and_runs_over_lines(table):
    other = " ".join(f"word{i} of the software" for i in range(60))
    body = {i: "\n".join(f" * {x}" for x in textwrap.wrap(L.TEMPLATES[i][1], 72)) for i in (1, 4, 5, 7)}
    texts = [
        "Copyright 2024 Acme Inc. All rights reserved.",
        "This project is released under the MIT License. See the file.\nNothing else here.",
        *(f"{other}\n{x}\nint main()\n{other}" for x in body.values()),
        f"{other} {L.TEMPLATES[7][1]} {other} {L.TEMPLATES[7][1].replace('any later', 'another')} All rights reserved, {other}",
        f"{other}\nAll rights reserved.\nx all rights reserved, all rights reserved y all rights reserved",
        "All rights reserved.\nReleased under the MIT License.\nx", "all rights", "", " \n ",
    ]
    got = {}
    for r in L.license_scan(table(list(enumerate(texts)))).collect():
        if r.unit < 0:
            got.setdefault(r.doc_id, []).append((r.unit, r.template, round(r.dice, 9)))
    assert {d: sorted(x) for d, x in got.items()} == {d: x for d, t in enumerate(texts) if (x := _runs(t))}
    assert [x[1] for x in got[0]] == [17] and 2 in [x[1] for x in got[1]] and len(got[6]) > 4
    for doc, i in enumerate(body, 2):
        assert (i, 1.0) in [x[1:] for x in got[doc]]
    assert 8 not in got


def test_many_notices_in_one_long_text(spark):
    import time

    body = next(t for n, t in L.TEMPLATES if n.upper().startswith("MIT") and len(t.split()) > 100)
    text = " ".join(f"{' '.join(f'word{i}x{j}' for j in range(90))} {body}" for i in range(60))
    df = spark.createDataFrame([(1, text), (2, "nothing")], "doc_id long, text string")
    L.license_scan(df.where("doc_id = 2")).collect()
    t0 = time.perf_counter()
    rows = [r for r in L.license_scan(df).collect() if r.unit < 0]
    assert time.perf_counter() - t0 < 20
    assert len({r.unit for r in rows if r.dice == 1.0}) == 60 and {r.doc_id for r in rows} == {1}


def test_bodies_wrapped_in_longer_texts(spark):
    names = ["bsd-2-clause", "bsd-3-clause", "zlib", "bsl-1.0", "lgpl-3.0", "lgpl-2.1", "agpl-3.0", "epl-2.0", "unlicense"]
    bodies = {n: t for n, t in L.TEMPLATES if n in names}
    assert sorted(bodies) == sorted(names)
    docs = [(i, f"A file of its own words {n}\nand more of them\n" + "\n".join(textwrap.wrap(bodies[n], 72)) + "\n" + "\n".join(f"line{j} of the file{j}" for j in range(200))) for i, n in enumerate(names)]
    rows = L.license_scan(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    for i, n in enumerate(names):
        best = max((r for r in rows if r.doc_id == i), key=lambda r: r.dice)
        assert best.license == n and best.dice == 1.0 and best.unit < 0
