import hashlib
import random
import re

from framecurate.llm import secrets as X

PATTERNS = {
    "assign": r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+", "hex": r"[0-9a-f]+",
    "login": r"""(?i:user(?:name)?|login|client_?id|account)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,}""",
    "key": r"[A-Za-z0-9+/]+", "endpoint": r"""https?://[^\x09-\x0D\x20"'<>]+"""}
KINDS = list(PATTERNS)


def plain(text):
    spans = []
    for k, p in PATTERNS.items():
        for m in re.finditer(p, text or "", re.A):
            ok = {"assign": lambda: len(m[2]) >= 6, "access": lambda: len(m[0]) >= 20, "hex": lambda: len(m[0]) >= 24,
                  "key": lambda: len(m[0]) >= 40 and re.search("[A-Z]", m[0]) and re.search("[a-z]", m[0])
                  and re.search("[0-9]", m[0])}.get(k, lambda: True)()
            if ok:
                spans.append((m.start(), KINDS.index(k), m.end()))
    base = sorted(s for s in spans if s[1] < 3)
    need = {"login": ("assign", "hex", "key"), "key": ("access", "login"), "endpoint": ("assign", "hex", "key")}
    weak = [s for s in spans if s[1] >= 3 and any(
        KINDS[p[1]] in need[KINDS[s[1]]] and p[0] <= s[2] + 200 and p[2] >= s[0] - 200
        and (p[0] >= s[2] or p[2] <= s[0]) for p in spans)]
    told = [",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(x)) for x in (base, base + weak)]
    return hashlib.sha256(told[0].encode()).hexdigest(), told[1], len(weak)


def texts():
    rng = random.Random(6)
    key = "aB3" + "".join(rng.choice("ABCdef123+/") for _ in range(37))
    bits = ["password=abc123", "Token : 'abc'", "secret=token: abcdefgh", "api_key=\"xyz_789.a=\"", "APIKEY: short1",
            "AKIA" + "Z9" * 8, "AKIASHORT", "deadbeef" * 3, "deadbeef" * 2, "username: bob.smith", "account=ab", key,
            "https://api.example.org/v1", "http://x", "é日本😀", "\n", "word " * 15, "word " * 45, "passwd:zzzzzz"]
    return ["".join(rng.choice(bits) + rng.choice((" ", " ", "\n", "")) for _ in range(rng.randint(1, 30)))
            for _ in range(250)] + ["user: alice " + "x " * 90 + key, "user: alice " + "x " * 110 + key,
                                    f"https://h.example/p {key}", "https://h.example/p alone", None, "", "feed" * 30_000]


def test_equal_to_brute_force(llm_spark, odd_docs):
    rows = [(i if i % 9 else None, t) for i, t in enumerate(texts())] + [(5, texts()[5])] * 3
    docs = llm_spark.createDataFrame(rows, "doc_id long, text string").unionByName(odd_docs.select("doc_id", "text"))
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = X.find_secrets(docs).collect()
    assert sorted(((r["doc_id"], r["base_sha256"], r["spans"], r["n_linked"]) for r in got), key=str) == \
        sorted(((d, *plain(t)) for d, t in rows), key=str)
    assert sum(r["n_linked"] for r in got) > 50
    for r in got:
        for k in ("assign", "access", "hex"):
            assert r[f"n_{k}"] == sum(s.startswith(k) for s in r["spans"].split(","))


def test_columns_and_empty_table(odd_docs, no_docs):
    assert X.find_secrets(odd_docs).count() == odd_docs.count()
    assert X.find_secrets(no_docs).collect() == []
