"""Licences found in their published texts and headers, as they are wrapped and marked there."""

from __future__ import annotations

import pytest

from tidewatch.llm import licences

MIT = """MIT License

Copyright (c) 2024 A. Writer

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
"""
BSD = """Copyright (c) The Regents of the University of California.
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions
are met:
1. Redistributions of source code must retain the above copyright
   notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright
   notice, this list of conditions and the following disclaimer in the
   documentation and/or other materials provided with the distribution.
"""
ENDORSE = """3. Neither the name of the University nor the names of its contributors
   may be used to endorse or promote products derived from this software
   without specific prior written permission.
"""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
"""
APACHE = """# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
"""
ASF = """ * The ASF licenses this file to You under the Apache License, Version 2.0
 * (the "License"); you may not use this file except in compliance with
 * the License.
"""
APACHE_TEXT = """                                 Apache License
                           Version 2.0, January 2004
                        http://www.apache.org/licenses/

   TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION
"""
GNU = """    This {what} is free software{mark} you can redistribute it and/or modify
    it under the terms of the GNU {name} as published by
    the Free Software Foundation, either version {v} of the License, or
    (at your option) any later version.
"""
GNU_TEXT = """                    GNU {name}
                       Version {v}, {date}

 Copyright (C) 2007 Free Software Foundation, Inc. <https://fsf.org/>
 Everyone is permitted to copy and distribute verbatim copies
 of this license document, but changing it is not allowed.
"""
MPL = """/* This Source Code Form is subject to the terms of the Mozilla Public
 * License, v. 2.0. If a copy of the MPL was not distributed with this
 * file, You can obtain one at https://mozilla.org/MPL/2.0/. */
"""
MPL_TEXT = """Mozilla Public License Version 2.0
==================================

1. Definitions
--------------

1.1. "Contributor"
    means each individual or legal entity that creates, contributes to
    the creation of, or owns Covered Software.
"""
UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or
distribute this software, either in source code form or as a compiled
binary, for any purpose, commercial or non-commercial, and by any
means.
"""
CC0 = """Creative Commons Legal Code

CC0 1.0 Universal

Certain owners wish to permanently relinquish those rights to a Work for
the purpose of contributing to a commons of creative, cultural and
scientific works ("Commons")
"""
CASES = [
    (MIT, "MIT"), (BSD, "BSD-2-Clause"), (BSD + ENDORSE, "BSD-3-Clause"), (ISC, "ISC"), (APACHE, "Apache-2.0"), (ASF, "Apache-2.0"), (APACHE_TEXT, "Apache-2.0"),
    (BSD + "3. All advertising materials mentioning features or use of this software\n   must display the following acknowledgement:\n" + ENDORSE, "BSD-4-Clause"),
    (GNU.format(what="program", mark=":", name="General Public License", v="3"), "GPL-3.0"), (GNU.format(what="program", mark=";", name="General Public License", v="2"), "GPL-2.0"),
    (GNU.format(what="library", mark=";", name="Lesser General Public\n License", v="2.1"), "LGPL-2.1"), (GNU.format(what="program", mark=":", name="Affero General Public License", v="3"), "AGPL-3.0"),
    (GNU.format(what="library", mark=":", name="Lesser General Public License", v="3"), "LGPL-3.0"),
    (GNU_TEXT.format(name="GENERAL PUBLIC LICENSE", v="3", date="29 June 2007"), "GPL-3.0"), (GNU_TEXT.format(name="GENERAL PUBLIC LICENSE", v="2", date="June 1991"), "GPL-2.0"),
    (GNU_TEXT.format(name="LESSER GENERAL PUBLIC LICENSE", v="2.1", date="February 1999"), "LGPL-2.1"), (GNU_TEXT.format(name="LESSER GENERAL PUBLIC LICENSE", v="3", date="29 June 2007"), "LGPL-3.0"),
    (GNU_TEXT.format(name="AFFERO GENERAL PUBLIC LICENSE", v="3", date="19 November 2007"), "AGPL-3.0"),
    (MPL, "MPL-2.0"), (MPL_TEXT, "MPL-2.0"), (UNLICENSE, "Unlicense"), (CC0, "CC0-1.0"),
    ("This project is released under the MIT License.", "MIT"), ("It is distributed under the terms of the MIT license (MIT) - see the LICENSE file for details.\n", "MIT"),
    ("// SPDX-License-Identifier: GPL-2.0-or-later\n", "GPL-2.0"), ("Licensed under the GNU GPL v3 or later.", "GPL-3.0"), ("Published under the GPL.", "GPL"),
    ("Released under the BSD 3-Clause License.", "BSD-3-Clause"), ("Dataset text. All content is available under CC0 1.0.", "CC0-1.0"),
    ("This work is licensed under a Creative Commons Attribution 4.0 International License.", "CC-BY-4.0"),
    ("This work is licensed under the Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.", "CC-BY-NC-SA-4.0"),
    ("Creative Commons Attribution-NoDerivatives 4.0 International Public License\n\nBy exercising", "CC-BY-ND-4.0"),
    ("Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0"), ("Released under CC BY-NC-ND 4.0.", "CC-BY-NC-ND-4.0"), ("Released under CC BY-SA 4.0. All rights reserved.", "CC-BY-SA-4.0,proprietary"),
    ("It is not licensed under the MIT License.", ""), ("Some other library is released under the MIT License, they said.", ""), ("Released under the MIT License as an exception only.", ""),
]


@pytest.fixture(scope="module")
def found(spark):
    frame = spark.createDataFrame([(i, before + text + after) for i, (text, _) in enumerate(CASES) for before, after in (("", ""), ("Some text here.\n\n", "\nMore words, and the end.\r\n"))], "doc_id long, text string")
    return sorted((r["doc_id"], ",".join(r["licences"])) for r in licences.recognised(frame).collect())


def test_licences_of_published_texts(found):
    assert found == [(i, want) for i, (_, want) in enumerate(CASES) for _ in range(2)]


def test_every_licence_has_a_text():
    assert {name for name, _, _ in licences.RULES} == {x for _, want in CASES for x in want.split(",") if x}
