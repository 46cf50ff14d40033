"""Operator 8 against plain word matching; the method's own rules."""

import random
import re

from branchbook.llm import licenses as L


def brute(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places = []
    for phrase, label in L.BASE:
        p = phrase.split()
        places += [(i, label) for i in range(len(w)) if w[i:i + len(p)] == p]
    at = [i for i, _ in places]
    return len(w), len(places), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


def texts():
    r = random.Random(4)
    parts = ["GNU", "General", "public", "License", "apache", "license", "cc", "BY", "by-nc", "MIT", "é", "licenseé", "x",
             "4.0", "\n", "CC-BY", "gnu general public license", "apache\tLICENSE,", "cc by cc by"]
    return ["".join(r.choice(parts) + r.choice([" ", "-", "", ", "]) for _ in range(r.randint(0, 40))) for _ in range(400)] \
        + ["", None, "mit license " * 5000]


def test_base(spark):
    rows = list(enumerate(texts()))
    got = {r.doc_id: r for r in L.scan(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(t), t
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_rules_resolve_versions_and_containment():
    assert len(L.rules()) > 250
    label = lambda t: L.scan_text(t.encode())[5]
    assert label("Licensed under the Apache License, Version 2.0.") == "apache,apache-2.0"
    assert label("This work is licensed under the GNU Lesser General Public License v2.1") == "lgpl-2.1"
    assert label("GNU General Public License, version 3.") == "gpl,gpl-3.0"
    assert label("Licensed under CC BY-NC 4.0.") == "cc-by,cc-by-nc-4.0"
    assert label("SPDX-License-Identifier: BSD-3-Clause") == "bsd-3-clause"
    assert label("see creativecommons.org/licenses/by-sa/3.0/") == "cc-by-sa-3.0"
    assert label("released under the 3-clause BSD license") == "bsd-3-clause"
    assert label("a license to kill") == "" and label("") == ""


def test_containment_is_suppressed_like_the_direct_rule():
    r = random.Random(1)
    for _ in range(200):
        found = sorted((-r.randint(1, 3), 0, k, b := r.randint(0, 30), b + r.randint(1, 9)) for k in range(12))
        want = []
        for f in found:
            if not any(k[3] <= f[3] and f[4] <= k[4] for k in want):
                want.append(f)
        assert L._outer(found) == want


def test_short_forms_and_license_sentences():
    label = lambda t: L.scan_text(t.encode())[5]
    for text, want in (
            ("released under the GPL v3", "gpl-3.0"), ("This is GPLv3 software", "gpl-3.0"), ("under LGPL-2.1 only", "lgpl-2.1"),
            ("Released under MIT.", "mit"), ("Licensed under Apache 2.0", "apache-2.0"), ("MPL 2.0", "mpl-2.0"),
            ("distributed under the terms of the BSD 3-clause", "bsd-3-clause"), ("available under the GPL", "gpl"),
            ("Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated "
             "documentation files (the \"Software\"), to deal", "mit"),
            ("THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR\nIMPLIED, INCLUDING BUT NOT LIMITED TO "
             "THE WARRANTIES OF MERCHANTABILITY,\nFITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.", "mit"),
            ("Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the "
             "following conditions are met:", "bsd"),
            ("Neither the name of the University nor the names of its contributors may be used to endorse or promote products\n"
             "derived from this software", "bsd-3-clause"),
            ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
             "provided that the above copyright notice and this permission notice appear in all copies.", "isc"),
            ("you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free "
             "Software Foundation, either version 2 of the License, or (at your option) any later version.", "gpl,gpl-2.0"),
            ("Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
             "\"AS IS\" BASIS,", "apache-2.0"),
            ("This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable", "zlib"),
            ("This is free and unencumbered software released into the public domain.", "unlicense"),
            ("Das ist mit 2 Personen, the apache helicopter, submit it", ""),
            ("Apache 2.0 licensed", "apache-2.0"), ("runs on Apache 2.0 and AFL 2", "")):
        assert label(text) == want, (text, label(text))


def test_a_megabyte_of_phrases_is_linear():
    import time
    start = time.process_time()
    n, found, first, last, *_ = L.scan_text(b"mit license " * 80_000)
    assert (n, found, first, last) == (160_000, 80_000, 0, 159_998)
    assert time.process_time() - start < 30
