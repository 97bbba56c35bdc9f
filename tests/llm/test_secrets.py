import hashlib
import re

from claimweave.llm import secrets

HEX = "0123456789abcdef" * 3
TEXTS = [
    "password=hunter2hunter2 and token: \"abcdefgh\" then API_KEY = 'x.y=z/+-_1'",
    "passwd:short secret=12345678secret=abcdefgh AKIAABCDEFGHIJKL AKIASHORT",
    f"{HEX} x{HEX[:31]} token={HEX}",
    "ſecret=abcdefghij toKen=abcdefghij PASSWORD  =  qqqqqqqq",
    None,
    "",
    "éé password=abcdefgh",
    "Zq9_" * 8 + " plain words",
]


def brute(text):
    text = text or ""
    out = []
    for kind, pattern, least, group in (
        ("assign", r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, 2),
        ("access", "AKIA[A-Z0-9]+", 16, 0),
        ("hex", "[0-9a-f]+", 32, 0),
    ):
        out.append([(m.start(), kind, m.end()) for m in re.finditer(pattern, text) if len(m[group]) >= least])
    names = ["assign", "access", "hex"]
    flat = sorted((s for k in out for s in k), key=lambda s: (s[0], names.index(s[1])))
    joined = ",".join(f"{k}:{a}:{b}" for a, k, b in flat)
    return (*map(len, out), hashlib.sha256(joined.encode()).hexdigest(), joined)


def test_base_spans_match_brute_force(documents):
    got = {r["doc_id"]: r for r in secrets.scan_secrets(documents(list(enumerate(TEXTS)))).collect()}
    for i, t in enumerate(TEXTS[:-1]):
        r = got[i]
        base = ",".join(x for x in r["spans"].split(",") if not x.startswith("opaque"))
        assert (r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"], base) == brute(t), t
    assert got[7]["spans"] == "opaque:0:32" and got[7]["n_live"] == 1


def judged(documents, rows):
    return {r["doc_id"]: (r["n_live"], r["n_copied"], r["spans"]) for r in secrets.scan_secrets(documents(rows)).collect()}


def test_a_fork_does_not_make_an_example_but_fifty_owners_do(documents):
    key = "Zq9_" * 8
    two = [(i, f"{key} in file {i}", "en", f"owner{i % 2}") for i in range(4)]
    many = [(100 + i, f"{key}fifty in file {i}", "en", f"user{i}") for i in range(50)]
    filler = [(1000 + i, f"plain {i} words", "en", f"owner{i % 2}") for i in range(20)]
    got = judged(documents, two + many + filler)
    assert all(got[i] == (1, 0, "opaque:0:32") for i in range(4))
    assert all(got[100 + i] == (0, 1, "") for i in range(50))


def test_owners_and_repositories_are_counted_over_the_corpus(documents):
    texts = ["the first file of this owner holds", "another one has", "here it stands once more in"]
    rows = [(i, f"{t} password=ownedsecret", "en", "src0") for i, t in enumerate(texts)]
    rows += [(20 + i, "one text password=copied-in-place", "en", "src1") for i in range(9)]
    rows += [(30 + i, f"mine {i} password=sharedexample", "en", f"src{i}") for i in range(5)] + [(None, "password=sharedexample", "en", None)]
    found = secrets.candidates(documents(rows)).cache()
    counts = {tuple(r)[1:] for r in secrets.ownership(found).collect()}
    assert counts == {(1, 3, 4), (1, 1, 10), (6, 6, 4 + 10 + 3 + 1)}
    got = judged(documents, rows)
    assert all(got[i][:2] == (1, 0) for i in (0, 1, 2, 20, 28)) and all(got[i][:2] == (0, 1) for i in (30, 34, None))


def test_a_template_of_one_owner_is_an_example(documents):
    rows = [(i, f"file {i} {i * 7} of {i % 5} many {i * 3} has password=in-all-files", "en", "src0") for i in range(20)]
    rows += [(50 + i, f"page {i} {i * 11} on {i % 3} words {i * 5} has password=in-few-files", "en", "src0") for i in range(7)]
    rows += [(100 + i, f"nothing {i}", "en", "src0") for i in range(40)]
    got = judged(documents, rows)
    assert all(got[i][:2] == (0, 1) for i in range(20)) and all(got[50 + i][:2] == (1, 0) for i in range(7))


def test_many_base_spans_beside_many_runs():
    unit = "password=abcdefgh " + "Zq9_" * 8 + " "
    text = unit * 4000
    base = secrets.base_spans(text)
    assert len(base) == 4000 and len(secrets.opaque_spans(text, base)) == 4000


def test_near_copies_of_one_owner_keep_their_secret(documents):
    rows = [(i, f"{'Zq9_' * 8} words of copy {i}", "en", "src0") for i in range(8)]
    rows += [(20 + i, f"words {i} of others", "en", "src1") for i in range(3)]
    got = {r["doc_id"]: (r["n_live"], r["n_copied"], r["spans"]) for r in secrets.scan_secrets(documents(rows)).collect()}
    assert all(got[i] == (1, 0, "opaque:0:32") for i in range(8))


def test_no_documents(documents):
    assert secrets.scan_secrets(documents([])).count() == 0
