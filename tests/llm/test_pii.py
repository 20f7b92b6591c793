"""Added personal data: planted spans in disguised forms, and clean texts with look-alikes."""

import random

import pytest

from shopscope.llm import pii

WORDS = "stone river under light carries seven nothing green walk other bird window because paper quiet north early bread".split()


def _card(rng):
    body = [rng.randrange(10) for _ in range(15)]
    total = sum(d * 2 - 9 if d * 2 > 9 else d * 2 for d in body[::2]) + sum(body[1::2])
    return "".join(map(str, [*body, -total % 10]))


def _planted(rng):
    """(kind, disguised form) that no base pattern finds."""
    user, host, end = rng.choice(["mia", "tom.b", "r_7", "ole-k"]), rng.choice(["posthaus", "mailbox", "uni-x"]), rng.choice(["com", "org", "net", "de"])
    octets = [str(rng.randrange(1, 255)) for _ in range(4)]
    card = _card(rng)
    fours = [card[i:i + 4] for i in range(0, 16, 4)]
    phone = [str(rng.randrange(200, 999)), str(rng.randrange(200, 999)), f"{rng.randrange(10000):04d}"]
    kind = rng.choice(pii.KINDS)
    form = {
        "email": [f"{user} (at) {host} (dot) {end}", f"{user}[at]{host}.{end}", f"{user} @ {host}.{end}", f"{user}(at){host}(dot){end}", f"{user.replace('.', '')} at {host} dot {end}"],
        "ip": [sep.join(octets) for sep in ("[.]", " . ", "(dot)", " dot ")],
        "card": [sep.join(fours) for sep in (".", "/", " - ")],
        "phone": [f"({phone[0]}) {phone[1]}-{phone[2]}", ".".join(phone), f"00{rng.randrange(30, 50)} " + " ".join(phone), "-".join(phone)],
    }[kind]
    intro = {"email": "write to", "ip": "host", "card": "my card", "phone": "call me at"}[kind]
    return kind, rng.choice([intro, rng.choice(WORDS)]), rng.choice(form)


def _alike(rng):
    """Numbers and phrases that are no personal data."""
    n = lambda a, b: rng.randrange(a, b)
    return rng.choice([
        f"on {n(1900, 2030)}-{n(1, 13):02d}-{n(1, 29):02d} 10:30", f"isbn 978-3-16-{n(100000, 999999)}-0", f"pages {n(1, 99)}-{n(100, 200)}", f"lists {n(1, 9)},{n(10, 20)},{n(20, 30)},{n(30, 40)}",
        f"version {n(1, 9)}.{n(1, 20)}.{n(1, 99)}", f"look at example.com", f"{n(1, 9)},{n(100, 999)},{n(100, 999)}", f"invoice {n(10**9, 10**10)}", f"at noon. then", f"{n(1, 24)}:{n(10, 59)}:{n(10, 59)}",
        f"key {n(16, 250):x}a{n(10**9, 10**10)}f{n(10**9, 10**10)}", f"from {n(1900, 1950)}-{n(1951, 1999)}", f"the score was {n(1, 9)}:{n(1, 9)}"])


def _texts(seed, n, base):
    """(text, planted spans or None for clean) of documents."""
    rng, out = random.Random(seed), []
    for i in range(n):
        text, spans = " ".join(rng.choices(WORDS, k=rng.randrange(3, 25))), []
        for _ in range(rng.randrange(1, 4)):
            if i % 2:
                kind, intro, form = _planted(rng)
                start = len(text) + len(intro) + 2
                text, spans = f"{text} {intro} {form}", [*spans, (kind, start, start + len(form))]
            else:
                text = f"{text} {_alike(rng)}"
            text += " " + " ".join(rng.choices(WORDS, k=rng.randrange(2, 9)))
        if base and i % 3 == 0:
            text += rng.choice([f" mail u{i}@a{i}.example.org", f" host 10.1.{i % 250}.7", " card 4111 1111 1111 1111", f" tel +1 (212) 555-{i:04d}", f" +1 (312) 555-{i:04d}"])
        out.append((text, spans))
    return out


@pytest.mark.parametrize("n, base", [(600, True), (40, True), (400, False)])
def test_disguised_forms_are_found_and_clean_texts_left_alone(docs, n, base):
    texts = _texts(n, n, base)
    found = {r.doc_id: r for r in pii.pii_digest(docs([(i, t) for i, (t, _) in enumerate(texts)])).collect()}
    caught, planted, wrong, missed = {}, {}, [], []
    for i, (text, spans) in enumerate(texts):
        got = [(k, int(a), int(b)) for k, a, b in (s.split(":") for s in found[i].spans.split(",") if s)]
        assert found[i].n_spans == len(got)
        for kind, a, b in spans:
            planted[kind] = planted.get(kind, 0) + 1
            hit = any(k == kind and c < b and a < d for k, c, d in got)
            caught[kind] = caught.get(kind, 0) + hit
            if not hit:
                missed.append(text[a - 12:b])
        base_spans = found[i].n_email + found[i].n_ip + found[i].n_card + found[i].n_phone
        if not spans and len(got) > base_spans:
            wrong.append([text[a - 12:b] for _, a, b in got])
    for kind in planted:
        assert caught[kind] >= 0.9 * planted[kind], (kind, caught, planted, missed[:20])
    assert len(wrong) <= 0.02 * n, wrong[:20]


def test_a_kind_whose_negatives_score_as_high_adds_nothing(spark):
    from pyspark.sql import functions as F

    rows = [(1, True, 0.9, 50.0), (1, True, 0.6, 50.0), (1, False, 0.7, 100.0), (2, True, 0.8, 10.0), (2, False, 0.8, 90.0), (3, True, 0.4, 9.0)]
    cells = spark.createDataFrame(rows, "kind_no int, label boolean, s double, weight double")
    assert pii.calibrated(cells, F.col("s")) == {1: pytest.approx(0.8)}
