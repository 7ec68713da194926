"""Quality ledger, licence scan and personal data against brute force."""

import random
import re

from strata.llm import license_scan, pii_anchors, quality_ledger

DOCS = "doc_id long, text string, n_words string, spans string, matches int"


def docs(spark, texts):
    return spark.createDataFrame([(i, t, "x", "y", 0) for i, t in enumerate(texts)], DOCS)


def _brute_measures(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    covered = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines), len(lines) - len(set(lines)), len(covered), len(re.findall("[A-Z]", t)), t.count("!"))


def _texts():
    rng = random.Random(2)
    words = ["a", "b", "É", "dd", "x#", "|", "\n", "\n", "  ", "\t", "!!", "NO", "🙂", "\u00a0", "\u2003"]
    return [None, "", " \n\t ", "one"] + ["".join(rng.choice(words) + rng.choice(["", " "]) for _ in range(rng.choice([3, 20, 120]))) for _ in range(120)] + ["word " * 30_000]


def test_measures(spark):
    texts = _texts()
    got = {r.doc_id: tuple(r[m] for m in quality_ledger.MEASURES) for r in quality_ledger.measure(docs(spark, texts)).collect()}
    for i, t in enumerate(texts[:-1]):
        assert got[i] == _brute_measures(t), t
    assert got[len(texts) - 1][:2] == (30_000, 120_000)
    assert got[len(texts) - 1][5] == 30_000


def test_policies_and_ablation(spark):
    book = quality_ledger.ledger(quality_ledger.measure(docs(spark, [*_texts(), " ".join(f"w{i}" for i in range(60))])))
    rows = quality_ledger.apply_policy(book, 2).collect()
    names = [n for n, _ in quality_ledger.rules()]
    fails = [{names[b] for b in range(len(names)) if r.failed >> b & 1} for r in rows]
    policy = set(quality_ledger.POLICIES[2])
    assert [r.kept for r in rows] == [not f & policy for f in fails]
    for r in quality_ledger.ablation(book, 2).collect():
        assert r.n == len(rows)
        assert r.n_failed == sum(r.rule in f for f in fails)
        assert r.n_only == sum(f & policy == {r.rule} for f in fails)
        assert r.n_kept_without == sum(not f & (policy - {r.rule}) for f in fails)


def test_empty_tables(spark):
    none = docs(spark, [])
    assert quality_ledger.apply_policy(quality_ledger.ledger(quality_ledger.measure(none)), 1).count() == 0
    assert license_scan.scan(none).count() == 0
    assert pii_anchors.find_pii(none).count() == 0
    assert pii_anchors.redact(none).columns == none.columns


def _brute_licenses(text):
    """Every window of every template's size, at every word."""
    w = re.findall(r"[^\W_]+", (text or "").lower())
    found = {}
    for name, body in license_scan.TEMPLATES:
        size = len(re.findall(r"[^\W_]+", body))
        b = set(license_scan.template_bigrams(body))
        for s in range(2 - size, len(w) - 1):
            lo, hi = max(s, 0), min(s + size, len(w))
            a = {f"{x} {y}" for x, y in zip(w[lo:hi], w[lo + 1 : hi], strict=False)}
            if a and 2 * len(a & b) / (len(a) + len(b)) >= 0.8:
                found.setdefault(name, []).append((lo, hi, 2 * len(a & b) / (len(a) + len(b))))
    out = []
    for name, windows in sorted(found.items()):
        places = []
        for lo, hi, dice in sorted(windows):
            if places and lo < places[-1][1]:
                places[-1] = (places[-1][0], max(hi, places[-1][1]), max(dice, places[-1][2]))
            else:
                places.append((lo, hi, dice))
        out += [(name, round(dice, 9), lo, hi - lo) for lo, hi, dice in places]
    return out


def _scanned(spark, texts):
    return {r.doc_id: [(m.license, round(m.dice, 9), m.start, m.words) for m in r.matches] for r in license_scan.scan(docs(spark, texts)).collect()}


def test_licenses(spark):
    rng = random.Random(8)
    texts = [None, "", "license", "by by", "prose. Licensed under CC BY-NC 4.0.", "x\nReleased under the MIT License.\nLicensed under the Apache License, Version 2.0. more"]
    for _ in range(150):
        w = rng.choice(license_scan.TEMPLATES)[1].split()
        for _ in range(rng.randint(0, 3)):
            i = rng.randrange(len(w))
            w = rng.choice([w[:i] + w[i + 1 :], [*w[:i], "other", *w[i:]], [*w[:i], w[i].upper() + "!", *w[i + 1 :]]]) or ["x"]
        glue = rng.choice([" ", "\n", "\n * "])
        texts.append(rng.choice(["", "Some prose here.\n", "prose; "]) + glue.join(w) + rng.choice(["", " and more. ", "\n\n" + glue.join(rng.choice(license_scan.TEMPLATES)[1].split())]))
    got = _scanned(spark, [*texts, "words and more by nc license " * 20_000])
    for i, t in enumerate(texts):
        assert got[i] == _brute_licenses(t), t
    assert sum(map(bool, got.values())) > 100 and got[len(texts)] == []


MIT = """Copyright (c) 2020 A. Person

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included."""
GPL = """# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version."""


def test_notices_over_lines_and_within_sentences(spark):
    wrapped = "Intro.\n  This work is licensed under the GNU General\n  Public License, version 3.\nEnd."
    inside = "Note that unless stated otherwise this work is licensed under the GNU General Public License, version 3, see the file COPYING for details and the list of all that took part."
    got = _scanned(spark, [MIT, wrapped, inside, GPL, "An essay on the general public and its license to speak."])
    names = {i: {n for n, _, _, _ in found} for i, found in got.items()}
    assert "mit" in names[0] and all("gpl-3.0" in names[i] for i in (1, 2, 3)) and not names[4]
    assert max(d for n, d, _, _ in got[0] if n == "mit") == 1.0 == max(d for n, d, _, _ in got[3] if n == "gpl-3.0")


def test_best_places(spark):
    df = license_scan.scan(docs(spark, ["This work is licensed under the GNU Lesser General Public License, version 3. " * 2 + "Gap of some words. Released under the MIT License"]))
    assert [m.license for m in df.select(license_scan.best_places(df["matches"]).alias("b")).first().b] == ["lgpl-3.0", "mit"]


def _brute_spans(t):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m.group())
        if 14 <= len(d) <= 19 and pii_anchors.luhn(d):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return sorted(out)


def _private_texts():
    rng = random.Random(6)
    return [None, "", "@", "a@b", "x a.b@c.de. 1.2.3.4.5.6.7.8 +1 (377) 555-0271 4539 1488 0343 6467", "é🙂 me@x.org", "9" * 5000, "1." * 3000] + ["".join(rng.choice("ab1234567890.. -+()@@é") for _ in range(rng.choice([8, 40, 150]))) for _ in range(1500)]


def test_base_spans(spark):
    texts = _private_texts()
    got = {r.doc_id: [(s.start, pii_anchors.KINDS.index(s.kind), s.end) for s in r.spans if s.kind in pii_anchors.BASE] for r in pii_anchors.find_pii(docs(spark, texts)).collect()}
    for i, t in enumerate(texts):
        assert got[i] == _brute_spans(t or ""), t


def test_added_spans_and_redaction(spark):
    text = "see https://www.example.com/a?b=1 or IBAN: GB82 WEST 1234 5698 7654 32, account number 12345678; Konto 99 iban GB00WEST12345698765432"
    found = [(pii_anchors.KINDS[k], text[s:e]) for s, k, e in pii_anchors.Finder().spans(text)]
    assert found == [("url", "https://www.example.com/a?b=1"), ("iban", "GB82 WEST 1234 5698 7654 32"), ("account", "12345678")]
    texts = ["mail a@b.cd now", None, "", "+1 (377) 555-0271", "clean"]
    got = {r.doc_id: r.text for r in pii_anchors.redact(docs(spark, texts)).collect()}
    assert got == {0: "mail [EMAIL] now", 1: None, 2: "", 3: "[PHONE]", 4: "clean"}
    for t in _private_texts():
        if t:  # spans survive nowhere: each becomes a placeholder
            s = pii_anchors.Finder().spans(t)
            assert pii_anchors.redact_text(t, s).count("[") == sum(all(e2 <= s1 or s2 >= s1 for s2, _, e2 in s[:i]) for i, (s1, _, _) in enumerate(s)) or any(b[0] < a[2] for a, b in zip(s, s[1:], strict=False))


def test_accounts_and_ibans_of_any_wording():
    find = lambda t: [(pii_anchors.KINDS[k], t[s:e]) for s, k, e in pii_anchors.Finder().spans(t) if k > 4]
    for cue in ("Account Number: ", "Account No. ", "ACCOUNT NUMBER ", "account number is ", "Acct. no.: ", "AcCount #", "Konto-Nr. ", "İ Kontonummer: "):
        assert find(f"{cue}12345678.") == [("account", "12345678")], cue
    spain, belgium = "ES91 2100 0418 4502 0005 1332", "BE68 5390 0754 7034"
    for before in ("IBAN: ", "iban number is ", "", "pay to ", "("):
        for after in ("", " BIC CAIXESBB", " EUR", ".", "\nXY", ", 12"):
            for x in (spain, belgium, spain.replace(" ", ""), belgium.lower()):
                assert find(before + x + after) == [("iban", x)], before + x + after
    for none in ("ES92 2100 0418 4502 0005 1332", "xES9121000418450200051332", "ES91210004184502000513321", "no12 this is text", "ab12", "12", "a1", "é12 34", "XX00 1234 5678 9012"):
        assert find(none) == [], none
    assert find(f"{spain} {belgium}") == [("iban", spain), ("iban", belgium)]


def test_licenses_in_their_true_wording(spark):
    texts = [
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy',
    ]
    got = {r.doc_id: [(m.license, m.dice, m.start) for m in r.matches if m.dice == 1][0] for r in license_scan.scan(docs(spark, texts)).collect() if r.matches}
    assert got == {i: (name, 1.0, 0) for i, name in enumerate(("mit", "apache-2.0"))}
