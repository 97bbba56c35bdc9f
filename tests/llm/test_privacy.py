import hashlib
import re

from claimweave.llm import privacy

TEXTS = [
    "mail a.b+c@d-e.co.uk, x@y and @z.com; p@q.r@s.t a@b..c",
    "ip 1.2.3.4 256.1.1.1 1.2.3.4.5 001.002.003.004 1.2.3 9.9.9.9.9.9.9.9",
    "card 4111 1111 1111 1111 4111-1111-1111-1112 41111111111111111111 378282246310005 4222222222222",
    "phone +1 (988) 555-2485 +123 +12345678 +1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 end+44-20",
    None,
    "",
    "é +1 (555) 555-1234 é@é.com e@é.com user@host.com.",
    "0" * 5000 + ".1.1.1",
]


def brute(text):
    text = text or ""

    def luhn(d):
        s = 0
        for k, c in enumerate(d[::-1]):
            x = int(c) * (2 if k % 2 else 1)
            s += x if x < 10 else x - 9
        return s % 10 == 0

    digits = lambda s: re.sub("[^0-9]", "", s)
    small = lambda p: len(p.lstrip("0")) < 4 and int("0" + p.lstrip("0")) <= 255
    rules = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(small(p) for p in s.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 16 <= len(digits(s)) <= 19 and luhn(digits(s))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 8 <= len(digits(s)) <= 15),
    ]
    found = [[(k, m.start(), m.end()) for m in re.finditer(p, text) if ok(m[0])] for k, p, ok in rules]
    joined = ",".join(f"{k}:{a}:{b}" for f in found for k, a, b in f)
    return (*map(len, found), hashlib.sha256(joined.encode()).hexdigest(), joined)


def test_base_spans_match_brute_force(documents):
    got = {r["doc_id"]: tuple(r)[1:] for r in privacy.personal_data(documents(list(enumerate(TEXTS)))).collect()}
    for i, t in enumerate(TEXTS):
        assert got[i] == brute(t), t


def revealing():
    rows = [(i, f"wizard {'abcdefgh'[i]}word lives at merlin@example.com often") for i in range(6)]
    return rows + [(10 + i, "often some other text about lives and words at home") for i in range(40)]


def test_terms_that_disclose_an_entity_are_spans(documents):
    got = {r["doc_id"]: r["spans"] for r in privacy.personal_data(documents(revealing())).collect()}
    for i in range(6):
        kinds = [s.split(":") for s in got[i].split(",")]
        text = revealing()[i][1]
        assert {text[int(a) : int(b)] for k, a, b in kinds if k == "term"} == {"wizard"}
    assert all(got[10 + i] == "" for i in range(40))


def test_far_and_short_terms_disclose_an_entity(documents):
    far = "some other text about words and lives " * 30
    texts = [f"Bo {far} wizard {'x@y.zz' if i % 2 else 'merlin@example.com'} {far} kim" for i in range(12)]
    texts = [t if i % 2 else t.replace("Bo", "Al").replace("kim", "zed") for i, t in enumerate(texts)]
    texts[1] = f"Bo wizard kim x@y.zz {far}"  # near in one, far in the others
    rows = list(enumerate(texts)) + [(20 + i, far) for i in range(40)]
    got = {r["doc_id"]: r["spans"] for r in privacy.personal_data(documents(rows)).collect()}
    for i, t in enumerate(texts):
        terms = [s.split(":")[1:] for s in got[i].split(",") if s.startswith("term")]
        assert {t[int(a) : int(b)] for a, b in terms} == ({"Bo", "kim"} if i % 2 else {"Al", "zed"})
    assert all(got[20 + i] == "" for i in range(40))


def test_short_lower_case_handles_disclose_an_entity(documents):
    rows = [(i, f"{'abcdefghijkl'[i]}word is x y qz of merlin@example.com") for i in range(8)] + [(20 + i, "some words of x y is here") for i in range(40)]
    got = {r["doc_id"]: r["spans"] for r in privacy.personal_data(documents(rows)).collect()}
    for i in range(8):
        text = rows[i][1]
        terms = [s.split(":")[1:] for s in got[i].split(",") if s.startswith("term")]
        assert {text[int(a) : int(b)] for a, b in terms} == {"qz"}


def test_sanitised_text_and_columns(documents):
    docs = documents(revealing() + [(99, None), (None, "x@y.zz")])
    out = {r["doc_id"]: r for r in privacy.sanitise(docs).collect()}
    assert out[0]["text"] == "[TERM] aword lives at [EMAIL] often" and out[0]["n_chars"] == len(out[0]["text"])
    assert out[10]["text"] == revealing()[6][1] and out[99]["text"] is None
    assert out[None]["text"] == "[EMAIL]" and privacy.sanitise(docs).columns == docs.columns


def test_no_documents(documents):
    assert privacy.personal_data(documents([])).count() == 0
    assert privacy.sanitise(documents([])).count() == 0
