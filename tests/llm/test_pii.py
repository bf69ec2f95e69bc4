import hashlib
import random
import re
from datetime import date, timedelta

from pyspark.sql import functions as F

from fileledger.llm import pii

KEY = "k"


def prf(kind, turn, half):
    return hashlib.sha256(f"{KEY}|{kind}|{turn}|{half}".encode()).hexdigest()


def shift(s, stream, hexed=""):
    out = ""
    for i, c in enumerate(s, 1):
        at = i * 3 % 61
        k = int(stream[at : at + 3], 16)
        alphabets = (["0123456789" + "abcdef" if hexed == "f" else "0123456789ABCDEF"] if hexed else []) + list(pii._ALPHABETS)
        for a in alphabets:
            if c in a:
                c = a[(a.index(c) + k) % len(a)]
                break
        out += c
    return out


def permute(s, kind, hexed=""):
    left, right = s[: len(s) // 2], s[len(s) // 2 :]
    for turn in range(1, 9):
        left, right = right, shift(left, prf(kind, turn, right), hexed)
    return left + right


def permute_number(v, sizes, kind):
    left, right = divmod(v, sizes[1])
    for turn in range(1, 9):
        if turn % 2:
            left = (left + int(prf(kind, turn, right)[:15], 16)) % sizes[0]
        else:
            right = (right + int(prf(kind, turn, left)[:15], 16)) % sizes[1]
    return left * sizes[1] + right


def luhn(body):
    total = 0
    for i, c in enumerate(reversed(body)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 * (d > 9)
    return str(-total % 10)


def replaced(spark, *texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r for r in sorted(pii.pseudonymise(df, KEY).collect(), key=lambda r: r.doc_id)]


def test_values_follow_the_plain_network(spark):
    card = "4111111111111111"
    day = date(2024, 2, 29)
    cycle = date(2000, 1, 1)
    moved = cycle + timedelta(days=permute_number((day - cycle).days, pii.DAYS, "date"))
    body = permute(card[:-1], "card")
    address = permute_number(int.from_bytes(bytes([10, 0, 200, 7]), "big"), pii.ADDRESSES, "ip")
    secret = "0123456789abcdef" * 2 + "deadbeef"
    local = "Jo.Smith_42"
    phone = permute("0175557713", "phone")
    want = f"card {body + luhn(body)}, on {moved.isoformat()} from {'.'.join(str(b) for b in address.to_bytes(4, 'big'))} by {permute(local, 'email')}@mail7.example.com key {permute(secret, 'secret', 'f')} +1 ({phone[:3]}) {phone[3:6]}-{phone[6:]}."
    got = replaced(spark, f"card {card}, on 2024-02-29 from 10.0.200.7 by {local}@mail7.example.com key {secret} +1 (017) 555-7713.")[0]
    assert got.text == want
    assert got.kinds == ["card", "date", "ip", "email", "secret", "phone"] and got.n_replaced == 6


def test_formats_stay_and_equal_values_stay_linked(spark):
    rows = replaced(spark, "4111 1111 1111 1111", "4111-1111-1111-1111 and 4111111111111111", "1/2/2020 02.01.2020 2020/01/02 13/12/2020", "SSN 123-45-6789", "GB82 WEST 1234 5698 7654 32", "DE89370400440532013000", "(212) 555-0100 +44 20 7946 0958")
    digits = lambda s: re.sub(r"\D", "", s)
    first = digits(rows[0].text)
    a, b = rows[1].text.split(" and ")
    assert digits(a) == b == first and re.fullmatch(r"(\d{4} ){3}\d{4}", rows[0].text) and first != "4" + "1" * 15
    assert luhn(first[:-1]) == first[-1]
    d1, d2, d3, d4 = rows[2].text.split()
    y, m, d = d3.split("/")
    assert (d1, d2) == (f"{int(m)}/{int(d)}/{y}", f"{d}.{m}.{y}") and re.fullmatch(r"\d\d?/\d\d?/\d{4}", d4)
    assert re.fullmatch(r"SSN \d{3}-\d{2}-\d{4}", rows[3].text) and "123-45-6789" not in rows[3].text
    for r in rows[4:6]:
        bare = r.text.replace(" ", "")
        assert int("".join(str(int(c, 36)) for c in bare[4:] + bare[:4])) % 97 == 1 and r.kinds == ["iban"]
    assert rows[6].text.split("+")[1].startswith("44 ") and rows[6].kinds == ["phone", "phone"]


def test_spellings_of_a_phone_number_stay_linked(spark):
    groups = [["+44 20 7946 0958", "+442079460958", "+44-20-7946-0958", "+44 (20) 7946 0958", "+44.20.7946.0958"], ["+1 212 555 0100", "+12125550100", "+1 (212) 555-0100"], ["+351 21 123 4567", "+351211234567"], ["+49 30 1234 5678", "+493012345678"]]
    rows = replaced(spark, *(" x ".join(g) for g in groups))
    for r, g in zip(rows, groups):
        bare = {re.sub(r"\D", "", t) for t in r.text.split(" x ")}
        old = re.sub(r"\D", "", g[0])
        assert len(bare) == 1 and bare != {old} and r.kinds == ["phone"] * len(g), r.text
        assert bare.pop()[: len(old) - 9].startswith(re.match("1|44|351|49", old)[0])
    national, abroad = replaced(spark, "(212) 555-0100", "+1 212 555 0100")
    assert re.sub(r"\D", "", abroad.text) == "1" + re.sub(r"\D", "", national.text)


def iban(country, own):
    check = 98 - int("".join(str(int(c, 36)) for c in own + country + "00")) % 97
    bare = f"{country}{check:02}{own}"
    return " ".join(bare[i : i + 4] for i in range(0, len(bare), 4))


def test_iban_ends_where_its_country_says(spark):
    ibans = [iban(c, "21000418450200051332987654321"[: n - 4]) for c, n in [("ES", 24), ("BE", 16), ("AT", 20), ("PL", 28), ("SE", 24), ("DE", 22), ("NO", 15), ("FR", 27), ("CR", 22), ("KZ", 20)]]
    after = ["BIC CAIXESBB", "2024 paid", "IBAN", "A", "1 USD"]
    texts = [f"IBAN {x} {a}" for x in ibans for a in after] + [f"{ibans[0]} {ibans[1]} {ibans[2]}", "IBAN ES91 2100 0418 4502 0005 1332 BIC CAIXESBB", f"{ibans[0]} 4111 1111 1111 1111"]
    rows = replaced(spark, *texts)
    for r, (x, a) in zip(rows, [(x, a) for x in ibans for a in after]):
        got = r.text.removeprefix("IBAN ").removesuffix(f" {a}")
        assert r.kinds == ["iban"] and r.text.endswith(f" {a}") and got != x and len(got) == len(x), r.text
        bare = got.replace(" ", "")
        assert int("".join(str(int(c, 36)) for c in bare[4:] + bare[:4])) % 97 == 1
    assert [r.kinds for r in rows[-3:]] == [["iban"] * 3, ["iban"], ["iban", "card"]]


def test_invalid_values_stay(spark):
    texts = ["4111111111111112", "2023-02-29", "300.1.1.1", "000-12-3456 666-12-3456 900-12-3456 123-00-6789", "GB82 WEST 1234 5698 7654 33", "1.2.3", "version 4.0.1", "12345", "a@b", "0000-01-01", "page 1234567"]
    for r, t in zip(replaced(spark, *texts), texts):
        assert r.text == t and r.n_replaced == 0, t


def test_permutations(spark):
    n = 189 * 773
    df = spark.range(0, n, 37).select("id", pii.permute_number(F.col("id"), pii.DAYS, F.lit("date"), KEY).alias("p"))
    got = df.collect()
    assert len({r.p for r in got}) == len(got) and all(0 <= r.p < n for r in got)
    s = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("s")).select("s", pii.permute_string(F.col("s"), F.lit("card"), KEY).alias("p")).collect()
    assert len({r.p for r in s}) == 1000 and all(r.p == permute(r.s, "card") for r in s)


def test_odd_rows(spark, odd_docs, no_docs):
    rows = pii.pseudonymise(odd_docs, KEY).collect()
    assert len(rows) == odd_docs.count()
    before = sorted((r.doc_id or 0, r.text or "") for r in odd_docs.where("doc_id <> 11 or doc_id is null").collect())
    assert sorted((r.doc_id or 0, r.text or "") for r in rows if r.doc_id != 11) == before
    assert [r.kinds for r in rows if r.doc_id == 11] == [["card"]]
    assert next(r.text for r in rows if r.doc_id == 4) is None
    assert pii.pseudonymise(no_docs, KEY).count() == 0
    assert replaced(spark, "4111111111111111")[0].text != [r.text for r in pii.pseudonymise(spark.createDataFrame([(0, "4111111111111111")], "doc_id long, text string"), "other").collect()][0]


def test_secrets_and_local_parts_of_any_length(spark):
    rng = random.Random(2)
    hexed = lambda n, digits="0123456789abcdef": "".join(rng.choice(digits) for _ in range(n))
    local = lambda n: "".join(rng.choice("abcXYZ019._") for _ in range(n - 1)) + "z"
    secrets = [hexed(n) for n in (32, 33, 127, 128, 129, 130, 1000)] + [hexed(n, "0123456789ABCDEF") for n in (128, 129, 400)] + [hexed(8_000)]
    mails = [f"{local(n)}@mail.example.com" for n in (1, 2, 63, 64, 65, 66, 300)] + ["jo.doe@a.b.c.d.e.f.g.h.i.j.k.example.org", f"{local(2000)}@x.de"]
    short = [hexed(31), "g" * 40, "abc@", "@x.de"]
    df = spark.createDataFrame([(i, f"so {v} it is") for i, v in enumerate(secrets + mails + short)], "doc_id long, text string")
    got = {r.doc_id: r for r in pii.pseudonymise(df, "k").collect()}
    for i, v in enumerate(secrets + mails):
        new = got[i].text.removeprefix("so ").removesuffix(" it is")
        assert got[i].n_replaced == 1 and got[i].kinds == ["secret" if i < len(secrets) else "email"] and len(new) == len(v) and (new != v or len(v) < 20)
        if i < len(secrets):
            assert set(new) <= set("0123456789abcdef" if v == v.lower() else "0123456789ABCDEF")
        else:
            assert new.split("@")[1] == v.split("@")[1]
    for i, v in enumerate(short, len(secrets + mails)):
        assert got[i].text == f"so {v} it is" and got[i].n_replaced == 0


def test_long_runs_take_linear_time(spark):
    import time

    texts = ["a." * 300_000, "0123456789abcdef" * 40_000 + "g", "a@" * 200_000, "x@" + "a." * 200_000]
    began = time.time()
    assert pii.pseudonymise(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"), "k").count() == 4
    assert {r.n_replaced for r in pii.pseudonymise(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"), "k").collect()} == {0}
    assert time.time() - began < 60
