"""Fixed patterns by Python's own expressions, random strings by a plain walk over all runs."""

import hashlib
import itertools
import random
import re
import string
import time

from seamwright.llm import secret_scan

DIGESTS = (32, 40, 48, 56, 64, 96, 128)


def is_random(run, ratio):
    size = sum(c.isalnum() for c in run)
    letters = [c for c in run if c.isalpha()]
    one_case = all(c.islower() for c in letters[1:]) or all(c.isupper() for c in letters)
    if size < (20 if one_case and not any(c.isdigit() for c in run) else 12) or ratio(run) >= 2:
        return False
    digest = re.fullmatch("[0-9a-f]+|[0-9A-F]+", run) and len(run) in DIGESTS
    uuid = re.fullmatch("[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}", run)
    parts = [p for p in re.split("[+/_=-]+", run) if p]
    named = len(parts) > 1 and all(re.fullmatch("[0-9]+|[a-z]+|[A-Z][a-z]*|[A-Z]+", p) and (p.isdigit() or len(p) <= 3 or ratio(p) >= 2) for p in parts)
    return not (digest or uuid or run.isdigit() or named)


def brute(text, enc):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A) if len(m[2]) >= 12]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    ratio = lambda x: len(x) / len(enc.encode_ordinary(x))
    spans = []
    for m in re.finditer("[A-Za-z0-9+/_=-]+", text):
        if any(a <= m.start() and m.end() <= b for a, _, b in out):
            continue
        free = [not any(a <= i < b for a, _, b in out) for i in range(m.start(), m.end())]
        pieces = ["".join(c for _, c in g) for own, g in itertools.groupby(zip(free, m[0], strict=True), key=lambda x: x[0]) if own]
        if any(is_random(p, ratio) for p in pieces):
            spans.append((m.start(), 3, m.end()))
    return sorted(out + spans)


def test_scan(spark):
    rng = random.Random(8)
    rnd = lambda n, chars=string.ascii_letters + string.digits + "+/": "".join(rng.choice(chars) for _ in range(n))
    pieces = [lambda: "word", lambda: "é日", lambda: rnd(28, string.ascii_letters), lambda: rnd(24), lambda: rnd(40, "0123456789abcdef"), lambda: rnd(64, "0123456789ABCDEF"), lambda: "user_name_of_2024_report_final",
              lambda: "8f14e45f-CEEA-467f-a9a4-1234567890ab", lambda: "Password = " + rnd(14), lambda: "AKIA" + rnd(16, string.ascii_uppercase), lambda: rnd(25, "0123456789"), lambda: "a_b_c_d_e_f_g_h_i_j_k_l_m_n_o_p_q_r_s_t", lambda: "-=" * 30, lambda: rnd(13), lambda: rnd(17), lambda: rnd(12, string.ascii_lowercase), lambda: rnd(14, "0123456789abcdef") + rnd(20, "0123456789abcdef") + "_final_report", lambda: rnd(15) + rnd(16, "0123456789abcdef") + rnd(15),
              lambda: "qzxkvj-wpfghq-zzkqxv-jjqwxz", lambda: "internationalisation-of-documentation"]
    texts = ["".join(rng.choice(pieces)() + rng.choice([" ", "\n", ",", ""]) for _ in range(rng.randrange(12))) for _ in range(300)] + ["", None]
    df = spark.createDataFrame([(i, t, "q") for i, t in enumerate(texts)], "doc_id long, text string, spans string")
    enc, found = secret_scan.encoding(), 0
    for r in secret_scan.find(df).collect():
        want = brute(texts[r["doc_id"]] or "", enc)
        join = lambda spans: ",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        assert r["spans"] == join(want) and [r[f"n_{k}"] for k in secret_scan.KINDS] == [sum(x[1] == k for x in want) for k in range(4)]
        assert r["base_sha256"] == hashlib.sha256(join(x for x in want if x[1] < 3).encode()).hexdigest()
        found += r["n_random"]
    assert found > 100 and secret_scan.find(df.limit(0)).count() == 0


def test_letters_alone_are_found():
    assert secret_scan.scan(b"x qZrXwKvJpTgYbNmLcDfHsQaWeUio y", secret_scan.encoding()) == [(2, 3, 30)]


def test_long_texts_take_linear_time():
    text = b"\n".join(hashlib.sha256(str(k).encode()).hexdigest().encode() + b"  file" for k in range(100_000))
    began = time.process_time()
    assert len(secret_scan.scan(text, secret_scan.encoding())) == 100_000
    assert len(secret_scan.scan(b"ab12" * 2_000_000, secret_scan.encoding())) == 1
    assert time.process_time() - began < 20


def test_recall_by_length():
    """Random base-62 strings of 12 characters and more, alone and with sixteen hexadecimal digits inside."""
    rng, enc = random.Random(9), secret_scan.encoding()
    rnd = lambda n, chars=string.ascii_letters + string.digits: "".join(rng.choice(chars) for _ in range(n))
    for n in (12, 14, 16, 18, 19, 20, 24, 32, 40):
        assert sum(any(k == 3 for _, k, _ in secret_scan.scan(f"see {rnd(n)} there".encode(), enc)) for _ in range(300)) >= 0.98 * 300, n
    whole = [rnd(30) + "g" + rnd(16, "0123456789abcdef") + "z" + rnd(28) for _ in range(200)]
    assert all((4, 3, 80) in secret_scan.scan(f"see {x} there".encode(), enc) for x in whole)


def test_digests_and_identifiers_stay_out():
    enc = secret_scan.encoding()
    for text in ("8f14e45fceea167a5a36dedd4bea2543_report_final", "sha256:" + "ab12" * 16, "getElementByIdentifier", "iPhone12ProMaxCase", "version_2024_11_28_final", "Donaudampfschiffahrt"):
        assert all(k != 3 for _, k, _ in secret_scan.scan(text.encode(), enc)), text
