from corpus import frame, none, odd
from docstruct.llm import licenses as li


def dice(a, b):
    a, b = li._bigrams(a), li._bigrams(b)
    return 2 * sum((a & b).values()) / (a.total() + b.total())


def test_notices_and_bodies(spark):
    mit = next(t for n, t in li.TEMPLATES if n == "MIT" and len(t) > 200)
    changed = mit.replace("free of charge", "without charge")
    half = changed.index(" ", len(mit) // 2)
    rows = [(1, "Some prose.\nReleased under the MIT License.\nMore."), (2, f"Title\n\n{changed[:half]}\n{changed[half:]}\n\nEnd"), (3, "the of a license and the of it"), (4, mit), (5, mit + " " + mit), (6, "LICENSED UNDER: CC BY-NC 4.0!")]
    got = {(r["doc_id"], r["licence"]): r["similarity"] for r in li.scan(frame(spark, rows, "doc_id long, text string")).collect()}
    assert got[1, "MIT"] == 1.0 and got[4, "MIT"] == 1.0 and got[6, "CC-BY-NC-4.0"] == 1.0
    assert abs(got[2, "MIT"] - dice(changed, mit)) < 1e-9
    assert {k[0] for k in got} == {1, 2, 4, 6}


def test_against_every_pair(spark):
    """Pruning by size and by known bigrams changes nothing."""
    texts = [t[: len(t) * k // 4] for _, t in li.TEMPLATES for k in (2, 3, 4)] + ["one two", "word", "license license license license"]
    got = {r["doc_id"]: (r["licence"], r["similarity"]) for r in li.scan(frame(spark, list(enumerate(texts)), "doc_id long, text string")).collect()}
    for i, t in enumerate(texts):
        best = max(((dice(t, body), name) for name, body in li.TEMPLATES if li._bigrams(t)), default=(0, ""))[0]
        assert (best >= li.THRESHOLD) == (i in got)
        if i in got:
            assert abs(got[i][1] - best) < 1e-9


def test_odd_rows(spark):
    assert li.scan(odd(spark)).count() == 0
    assert li.scan(none(spark)).count() == 0
    assert li.scan(odd(spark), templates=[]).count() == 0


def test_licences_over_several_paragraphs_of_a_longer_text(spark):
    mit = next(t for n, t in li.TEMPLATES if n == "MIT" and len(t) > 200)
    mit = mit.replace("subject to the following conditions: ", "subject to the following conditions:\n\n").replace("portions of the Software. ", "portions of the Software.\n\n")
    bsd = {n: t.replace(" 1. ", "\n\n1. ").replace(" 2. ", "\n\n2. ").replace(" 3. ", "\n\n3. ").replace(" THIS SOFTWARE", "\n\nTHIS SOFTWARE") for n, t in li.BODIES}
    gpl = next(t for n, t in li.TEMPLATES if n == "GPL-3.0" and "program" in t).replace(" the terms", "\nthe terms").replace(" either version", "\neither version")
    prose = "\n".join("It was the best of times in the house of the software makers and no one knew" for _ in range(60))
    bodies = {1: ("MIT", mit), 2: ("BSD-2-Clause", bsd["BSD-2-Clause"]), 3: ("BSD-3-Clause", bsd["BSD-3-Clause"]), 4: ("GPL-3.0", gpl)}
    rows = [(i, f"{prose}\n\n{t}\n\n{prose}") for i, (_, t) in bodies.items()] + [(9, prose)]
    found = li.scan(frame(spark, rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, found)) == [(i, n, 1.0, 1) for i, (n, _) in bodies.items()]
