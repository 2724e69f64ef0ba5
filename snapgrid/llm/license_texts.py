"""Templates of the license scan. Words in square brackets (names, versions) count word for word.

Short licenses stand in full or by their first paragraphs. Long ones stand by their name with its version, the notice that their authors ask for,
and their SPDX identifier. ``bsd`` and ``gpl`` are families: their notices without a version, or beside it.
"""

from __future__ import annotations


def _named(*names: str) -> list[str]:
    """Wordings of 'licensed under it' with a name too short to stand alone."""
    return [f"[{lead} {name}]" for name in names for lead in ("under the", "under", "of the", "by the")]


def _exact(*phrases: str) -> list[str]:
    return [f"[{phrase}]" for phrase in phrases]


def _spdx(*names: str) -> list[str]:
    return [f"[SPDX-License-Identifier: {name}]" for name in names]


_GPL = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the "
    "[GNU General Public License] as published by the Free Software Foundation"
)
_AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL '
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN "
    "ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF "
    "THIS SOFTWARE."
)
_MIT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"
_MIT_REST = (
    ' (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, '
    "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
    "Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission "
    "notice shall be included in all copies or substantial portions of the Software."
)
_BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted"
_BSD_TWO = (
    " provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
    "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above "
    "copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials "
    "provided with "
)
_BSD_NAME = (
    "3. Neither the name of the copyright holder nor the names of its [contributors may be used to endorse or promote products] "
    "derived from this software without specific prior written permission. "
)

TEMPLATES = {
    "apache-2.0": [
        "Licensed under the [Apache License, Version 2.0].",
        'Licensed under the [Apache License, Version 2.0] (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at",
        *_exact("Apache License, Version 2.0", "Apache License v2", "Apache License 2.0", "Apache 2.0 license", "Apache Software License 2.0"),
        *_exact("Apache License, Version 2"),
        *_spdx("Apache-2.0"),
    ],
    "mit": ["Released under the MIT License.", _MIT, _MIT + _MIT_REST, *_named("MIT License", "MIT Licence"), *_spdx("MIT")],
    "isc": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is [hereby granted, "
        "provided that] the above copyright notice and this permission notice appear in all copies. " + _AS_IS,
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is [hereby granted, "
        "provided that] the above copyright notice and this permission notice appear in all copies",
        *_named("ISC License", "ISC Licence"),
        *_spdx("ISC"),
    ],
    "0bsd": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "[hereby granted. THE SOFTWARE] IS PROVIDED",
        *_exact("BSD Zero Clause License", "Zero-Clause BSD"),
        *_spdx("0BSD"),
    ],
    "gpl": [_GPL],
    "gpl-3.0": [
        "This work is licensed under the [GNU General Public License, version 3].",
        _GPL + ", [either version 3 of the License]",
        _GPL + ", [version 3 of the License]",
        _GPL + ", [version 3. This program]",
        *_exact("GNU General Public License, version 3", "GNU General Public License v3", "GNU General Public License 3.0"),
        *_exact("GNU GPL v3", "GNU GPL version 3", "under the GPLv3", "under GPL v3", "the GPL v3", "under GPL version 3", "the GPL version 3"),
        *_exact("under the GPL 3.0", "under GPL 3.0", "licensed under GPLv3", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
        *_spdx("GPL-3.0"),
    ],
    "gpl-2.0": [
        "This work is licensed under the [GNU General Public License, version 2].",
        _GPL + "; [either version 2 of the License]",
        _GPL + "; [version 2 of the License]",
        _GPL + ", [version 2. This program]",
        *_exact("GNU General Public License, version 2", "GNU General Public License v2", "GNU General Public License 2.0"),
        *_exact("GNU GPL v2", "GNU GPL version 2", "under the GPLv2", "under GPL v2", "the GPL v2", "under GPL version 2", "the GPL version 2"),
        *_exact("under the GPL 2.0", "under GPL 2.0", "licensed under GPLv2", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
        *_spdx("GPL-2.0"),
    ],
    "agpl-3.0": [
        "you can redistribute it and/or modify it under the terms of the [GNU Affero General Public License] as published by the "
        "Free Software Foundation, either [version 3 of the License]",
        *_exact("GNU Affero General Public License, version 3", "GNU Affero General Public License v3", "GNU Affero General Public License 3.0"),
        *_exact("GNU AGPL v3", "GNU AGPL version 3", "under the AGPLv3", "under AGPL v3", "the AGPL v3", "under AGPL 3.0", "licensed under AGPLv3"),
        *_spdx("AGPL-3.0"),
    ],
    "lgpl-3.0": [
        "you can redistribute it and/or modify it under the terms of the [GNU Lesser General Public License] as published by the "
        "Free Software Foundation, either [version 3 of the License]",
        *_exact("GNU Lesser General Public License, version 3", "GNU Lesser General Public License v3", "GNU Lesser General Public License 3.0"),
        *_exact("GNU LGPL v3", "GNU LGPL version 3", "under the LGPLv3", "under LGPL v3", "the LGPL v3", "under LGPL 3.0", "licensed under LGPLv3"),
        *_spdx("LGPL-3.0"),
    ],
    "lgpl-2.1": [
        "you can redistribute it and/or modify it under the terms of the [GNU Lesser General Public License] as published by the "
        "Free Software Foundation; either [version 2.1 of the License]",
        *_exact("GNU Lesser General Public License, version 2.1", "GNU Lesser General Public License v2.1", "GNU Lesser General Public License 2.1"),
        *_exact("GNU LGPL v2.1", "GNU LGPL version 2.1", "under the LGPLv2.1", "under LGPL v2.1", "under LGPL 2.1", "the LGPL 2.1"),
        *_spdx("LGPL-2.1"),
    ],
    "lgpl-2.0": [*_exact("GNU Library General Public License"), *_spdx("LGPL-2.0")],
    "bsd": [_BSD, *_named("BSD License", "BSD Licence")],
    "bsd-3-clause": [
        _BSD + _BSD_TWO + "the distribution. " + _BSD_NAME,
        *_exact("BSD 3-Clause License", "3-Clause BSD License", "New BSD License", "Modified BSD License", "BSD-3-Clause license"),
        *_spdx("BSD-3-Clause"),
    ],
    "bsd-2-clause": [
        _BSD + _BSD_TWO + "[the distribution. THIS SOFTWARE] IS PROVIDED BY",
        *_exact("BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License", "FreeBSD License applies"),
        *_spdx("BSD-2-Clause"),
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the [Mozilla Public License, v. 2.0].",
        *_exact("Mozilla Public License, v. 2.0", "Mozilla Public License, version 2.0", "Mozilla Public License v2", "Mozilla Public License 2.0"),
        *_exact("under the MPL 2.0", "under MPL 2.0"),
        *_spdx("MPL-2.0"),
    ],
    "mpl-1.1": [*_exact("Mozilla Public License Version 1.1", "Mozilla Public License 1.1"), *_spdx("MPL-1.1")],
    "epl-2.0": [
        *_exact("Eclipse Public License v. 2.0", "Eclipse Public License version 2.0", "Eclipse Public License 2.0", "Eclipse Public License v2"),
        *_exact("under the EPL 2.0", "under EPL 2.0"),
        *_spdx("EPL-2.0"),
    ],
    "epl-1.0": [
        *_exact("Eclipse Public License v. 1.0", "Eclipse Public License version 1.0", "Eclipse Public License 1.0", "Eclipse Public License v1"),
        *_spdx("EPL-1.0"),
    ],
    "unlicense": [
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
        "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
        "commercial or non-commercial, and by any means.",
        "This is free and unencumbered software released into the public domain.",
        *_exact("under the Unlicense", "released under Unlicense", "licensed under Unlicense"),
        *_spdx("Unlicense"),
    ],
    "zlib": [
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable "
        "for any damages arising from the use of this software. Permission is granted to anyone to use this software for any "
        "purpose, including commercial applications, and to alter it and redistribute it freely",
        *_named("zlib License"),
        *_spdx("Zlib"),
    ],
    "bsl-1.0": [
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
        "accompanying documentation covered by this license",
        *_exact("Boost Software License, Version 1.0", "Boost Software License 1.0"),
        *_spdx("BSL-1.0"),
    ],
    "cc0-1.0": [*_exact("CC0 1.0 Universal", "under CC0 1.0", "creativecommons.org/publicdomain/zero/1.0"), *_spdx("CC0-1.0")],
    "all-rights-reserved": ["All rights reserved."],
}

_CC = {
    "by": "Attribution",
    "by-sa": "Attribution-ShareAlike",
    "by-nc": "Attribution-NonCommercial",
    "by-nd": "Attribution-NoDerivatives",
    "by-nc-sa": "Attribution-NonCommercial-ShareAlike",
    "by-nc-nd": "Attribution-NonCommercial-NoDerivatives",
}
for _version in ("4.0", "3.0", "2.0"):
    for _kind, _name in _CC.items():
        TEMPLATES[f"cc-{_kind}-{_version}"] = _exact(
            f"CC {_kind} {_version}", f"Creative Commons {_name} {_version}", f"creativecommons.org/licenses/{_kind}/{_version}"
        )
