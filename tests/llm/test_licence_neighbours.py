"""Licences that differ from a known family in a word or a version are not that family."""

from energy_series.llm import op10_licences

NEIGHBOURS = [
    "This work is licensed under the GNU Lesser General Public License, version 3",
    "This work is licensed under the GNU Affero General Public License, version 3",
    "This work is licensed under the GNU General Public License, version 2",
    "redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
    "redistribute it and/or modify it under the terms of the GNU General Public License; either version 2 of the License",
    "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License",
    "licensed under a Creative Commons Attribution 3.0 International License",
    "Licensed under CC BY-NC-SA 4.0",
    "Licensed under CC BY-SA 4.0",
    "subject to the terms of the Mozilla Public License, v. 1.1",
    "Licensed under the Apache License, Version 1.1",
    "not all rights reserved",
    "Permission to use, copy, modify, and/or distribute this software for any purpose",
]
MEMBERS = [
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl-3.0", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published"),
    ("gpl-3.0", "redistribute it and/or modify it under the terms of the GNU General Public License, either version 3 or version 2"),
    ("cc-by-4.0", "This text is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("mpl-2.0", "This file is subject to the terms of the\n# Mozilla Public License, v. 2.0. If a copy"),
    ("apache-2.0", "// Licensed under the Apache License,\n// Version 2.0 (the License)"),
    ("proprietary", "Copyright 2020. All rights reserved."),
    ("mit", "Released under the MIT License"),
]


def test_neighbours_are_unknown_and_members_are_found(spark):
    texts = [*NEIGHBOURS, *(text for _, text in MEMBERS)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in op10_licences.report(df, op10_licences.trained(df)).collect()}
    found = [(texts[i], got[i].licences, got[i].n_unknown > 0) for i in range(len(texts))]
    assert found[: len(NEIGHBOURS)] == [(t, "", True) for t in NEIGHBOURS]
    assert [f[:2] for f in found[len(NEIGHBOURS) :]] == [(t, family) for family, t in MEMBERS]
