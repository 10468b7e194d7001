"""Rights notices and notices over several lines."""

from __future__ import annotations

from tickloom.llm import license_scan
from tickloom.llm.queries import QUERIES

PROSE = "the quick brown fox jumps over the lazy dog and may not use this or that in the end of the day"
OTHERS = [(100 + i, f"{PROSE} {i} and some more words about nothing at all") for i in range(40)]


def scanned(spark, texts):
    rows = [*enumerate(texts), *OTHERS]
    got = {r.doc_id: r for r in license_scan.licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    return [got[i] for i in range(len(texts))]


def test_reserved_rights_of_given_documents(spark, sf_small):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    n = 0
    for r in QUERIES["op1_license_scan"](spark, sf_small).collect():
        at, want = 0, []
        for line in texts[r.doc_id].split("\n"):
            if line == "All rights reserved.":
                want.append(f"all-rights-reserved:{at}:{at + len(line)}")
            at += len(line) + 1
        assert r.reserved == ",".join(want)
        n += len(want)
    assert n == 3


def test_reserved_rights_amid_other_words(spark):
    line = "Copyright (c) 2019 Acme Corporation. All rights reserved."
    whole = "All rights reserved. No part of this work may be reproduced without prior written permission."
    a, b, c = scanned(spark, [f"{PROSE}\n{line}", whole, PROSE])
    assert (a.reserved, a.families) == (f"all-rights-reserved:{len(PROSE) + 1}:{len(PROSE) + 1 + len(line)}", "")
    assert (b.reserved, b.families) == ("", "proprietary") and (c.reserved, c.families) == ("", "")


WRAPPED = {
    "bsd": "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:",
    "lgpl": "This library is free software; you can redistribute it and/or\nmodify it under the terms of the GNU Lesser General Public\nLicense as published by the Free Software Foundation",
    "gpl": "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation, either version 3 of the License, or",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the \"Software\"), to deal",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above",
    "mpl": "This Source Code Form is subject to the terms of the Mozilla\nPublic License, v. 2.0. If a copy of the MPL was not distributed with\nthis file, You can obtain one at http://mozilla.org/MPL/2.0/.",
}


def test_wrapped_notices(spark):
    texts, want = [], []
    for family, notice in WRAPPED.items():
        for before, mark in (("", ""), (f"{PROSE}\n" * 30, ""), (f"{PROSE}\n\n", " * ")):
            notice_lines = "\n".join(mark + line for line in notice.split("\n"))
            texts.append(f"{before}{notice_lines}\n{PROSE}")
            want.append((family, f"{family}:{len(before)}:{len(before) + len(notice_lines)}"))
    got = [(r.families, r.spans) for r in scanned(spark, texts)]
    assert got == want


def test_two_wrapped_notices_in_one_paragraph(spark):
    a, b = WRAPPED["bsd"], WRAPPED["lgpl"]
    (r,) = scanned(spark, [f"{a}\n{PROSE}\n{b}\n{PROSE}\n{a}\n\n{PROSE}"])
    assert (r.n_paragraphs, r.n_licensed, r.families) == (2, 1, "bsd,lgpl")
    at = [0, len(a) + len(PROSE) + 2, len(a) + 2 * len(PROSE) + len(b) + 4]
    assert r.spans == f"bsd:0:{len(a)},lgpl:{at[1]}:{at[1] + len(b)},bsd:{at[2]}:{at[2] + len(a)}"
