import hashlib
import re

from hypothesis import given, settings, strategies as st

from metframe.llm import pii


def plain(text):
    """The formats as they are written, without care for speed."""
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub(r"\D", "", m[0])
        if 13 <= len(d) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0:
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub(r"\D", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def joined(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.sampled_from("a1250.@+- (%_é"), max_size=80))
def test_seeds_are_the_formats(text):
    assert pii.seeds(text) == plain(text)


def test_seeds_of_documents(documents):
    assert all(pii.seeds(t) == plain(t) for _, t in documents)
    assert pii.seeds("4111 1111 1111 1111, 1.2.3.4.5, 256.1.1.1 01.02.03.0255 a@b.c.d@e.f") == plain(
        "4111 1111 1111 1111, 1.2.3.4.5, 256.1.1.1 01.02.03.0255 a@b.c.d@e.f")


def test_long_runs_take_linear_time():
    for text in ("1" * 300_000 + ".1", "a" * 300_000 + "@", "a@" * 100_000, "1.1.1." * 50_000, "+1" * 100_000, "1 2 " * 50_000):
        own = pii.seeds(text)
        pii.alikes(text, own)


def test_patterns_find_unseen_identifiers(spark):
    docs = [(i, f"Please call me on +1 (201) 555-{1000 + i} or later.") for i in range(40)]
    docs += [(100, "They said: call me on 201 555 0199 or write."), (101, "there were 201 555 0188 of them"), (102, "mail x(at)y.org now")]
    docs += [(400 + i, f"write to user{i}@example.org now") for i in range(40)] + [(300, "Write to someone(at)example.org now")]
    got = {r.doc_id: r for r in pii.personal_data(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    texts = dict(docs)
    for i, kind, found in ((100, "phone", "201 555 0199"), (300, "email", "someone(at)example.org")):
        at = texts[i].index(found)
        assert got[i].spans == f"{kind}:{at}:{at + len(found)}"
        assert got[i].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert got[101].spans == got[102].spans == ""
    assert all(got[i].spans == joined(plain(texts[i])) and got[i].n_phone == 1 for i in range(40))


def test_odd_rows(odd, empty):
    from tests.llm.conftest import ODD

    rows = pii.personal_data(odd).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(i) for i, _ in ODD)
    assert {r.spans for r in rows} == {""}
    assert pii.personal_data(empty).count() == 0


def test_masking(spark):
    assert pii.mask("a b@c.d, 1.2.3.4 e", "email:2:7,ip:9:16") == "a [EMAIL], [IP] e"
    rows = [(1, "x 1.2.3.4", "k"), (None, "y b@c.d", "l"), (2, None, "m"), (1, "x 1.2.3.4", "n"), (3, "plain", None)]
    got = pii.masked(spark.createDataFrame(rows, "doc_id long, text string, row_key string"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(1, "x [IP]", "k"), (None, "y [EMAIL]", "l"), (2, None, "m"), (1, "x [IP]", "n"), (3, "plain", None)], key=str)


def test_accepted_identifiers_are_masked_at_every_place(spark):
    docs = [(i, f"Please call me on +1 (201) 555-{1000 + i} or later.") for i in range(40)]
    docs += [(100, "They said: call me on 201 555 0199 or write."), (101, "201 555 0199"), (102, "Tel 201 555 0199"), (103, "they " + "-" * 60 + " 201 555 0199")]
    got = {r.doc_id: r.spans for r in pii.personal_data(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    for i, text in docs[40:]:
        at = text.index("201 555 0199")
        assert got[i] == f"phone:{at}:{at + 12}"


def test_chains_of_patterns_are_followed_to_their_end(spark):
    number, docs = iter(range(1000, 9999)), []
    groups = [[f"201 555 {next(number)}" for _ in range(10)] for _ in range(7)]
    for k in range(6):
        own = [f"+1 201 555 {next(number)}" for _ in range(70 if k == 0 else 60)] + (groups[k] if k else []) + groups[k + 1]
        docs += [f"step {'abcdef'[k] * 3} {x}" for x in own]
    rows = pii.personal_data(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")).collect()
    assert all(r.spans for r in rows)


def test_patterns_of_all_places():
    assert [pii.pattern(t, len(t)) for t in ("", "Tel ", "call Me on ", "one " + "-" * 60, "call " + "-" * 60 + " me ")] == ["^", "^ tel", "me on", "...", "... me"]
    assert pii.pattern("donaudampfschiff is " + "x" * 20 + " " + "9" * 20, 41 + 20) == "is " + "x" * 20
    long = "a" * 100
    assert pii.pattern(f"{long} me ", 104) == pii.pattern(f"so {long} me ", 107) != pii.pattern(f"b{long} me ", 105)
