"""Public license texts and notices known to the license scan (name, text)."""

from __future__ import annotations

from pathlib import Path

#: Short licenses in full, and the usual one-line notices.
LICENSES = (
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\n"
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
        'the Software.\n\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING '
        "BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO "
        "EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN "
        "ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.\n\n"
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL '
        "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
        "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER "
        "IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
        "PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software.\n\nPermission is granted to anyone to use this "
        "software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject "
        "to the following restrictions:\n\n1. The origin of this software must not be misrepresented; you must not claim "
        "that you wrote the original software. If you use this software in a product, an acknowledgment in the product "
        "documentation would be appreciated but is not required.\n2. Altered source versions must be plainly marked as "
        "such, and must not be misrepresented as being the original software.\n3. This notice may not be removed or "
        "altered from any source distribution.",
    ),
    ("MIT-notice", "Released under the MIT License."),
    ("Apache-2.0-notice", "Licensed under the Apache License, Version 2.0."),
    ("CC-BY-NC-4.0-notice", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0-notice", "This work is licensed under the GNU General Public License, version 3."),
)

_BSD_2 = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer.\n\n2. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution.\n\n"
)
_BSD_3 = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission.\n\n"
)
_BSD_END = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF "
    "THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_UNLICENSE = (
    "This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy, modify, publish, use, "
    "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
    "commercial or non-commercial, and by any means.\n\nIn jurisdictions that recognize copyright laws, the author or authors "
    "of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication "
    "for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be "
    "an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.\n\n"
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE "
    "LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT "
    "OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.\n\n"
    "For more information, please refer to <https://unlicense.org/>"
)

#: Titles that stand above the body of a license.
TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)"),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)", "The ISC License (ISC)"),
    "Zlib": ("zlib License", "The zlib License", "zlib/libpng License", "The zlib/libpng License"),
    "BSD-2-Clause": (
        "BSD 2-Clause License", "The BSD 2-Clause License", 'BSD 2-Clause "Simplified" License', "Simplified BSD License", "BSD License",
    ),
    "BSD-3-Clause": (
        "BSD 3-Clause License", "The BSD 3-Clause License", 'BSD 3-Clause "New" or "Revised" License', "New BSD License",
        "Modified BSD License", "BSD License", "The BSD License",
    ),
    "Unlicense": ("The Unlicense", "Unlicense"),
}

#: Long licenses, in ``licenses/``, with the line that what some copies leave out begins with.
_FILES = {
    "Apache-2.0": "APPENDIX: How to apply",
    "CC0-1.0": None,
    "GPL-2": "How to Apply These Terms",
    "GPL-3": "How to Apply These Terms",
    "LGPL-2.1": "How to Apply These Terms",
    "LGPL-3": None,
    "MPL-2.0": "Exhibit A - Source Code Form",
}


def known() -> list[tuple[str, str]]:
    """(name, text): ``LICENSES``, further full texts, and each in the forms that files have."""
    short = [
        *LICENSES,
        ("BSD-2-Clause", _BSD_2 + _BSD_END),
        ("BSD-3-Clause", _BSD_2 + _BSD_3 + _BSD_END),
        ("Unlicense", _UNLICENSE),
        ("Unlicense", _UNLICENSE.replace("unlicense.org/", "unlicense.org")),
    ]
    texts = short + [(name, f"{title}\n\n{text}") for name, text in short for title in TITLES.get(name, ())]
    for name, end in _FILES.items():
        text = (Path(__file__).parent / "licenses" / f"{name}.txt").read_text("utf-8")
        texts.append((name, text))
        if end:
            texts.append((name, text[: text.index(end)]))
    return texts + [(name, text.replace("https://", "http://")) for name, text in texts if "https://" in text]
