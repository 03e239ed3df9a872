"""Licence texts and notices with their SPDX names; copyright lines are left out.

Short texts stand here, whole ones as published in ``spdx/``, a file for each licence.
"""

import re
from importlib.resources import files

# Texts as published by their authors.
_GRANT_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_GRANT_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies."""
_AS_IS_ISC = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING
ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""
_GRANT_0BSD = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted."""

TEXTS: dict[str, str] = {
    "MIT": f"MIT License\n{_GRANT_MIT}",
    "MIT-body": _GRANT_MIT,
    "ISC": f"ISC License\n{_GRANT_ISC}\n{_AS_IS_ISC}",
    "ISC-body": f"{_GRANT_ISC}\n{_AS_IS_ISC}",
    "0BSD": f"{_GRANT_0BSD}\n{_AS_IS_ISC}",
}
# Usual one-line notices.
NOTICES: dict[str, list[str]] = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "Licensed under the Apache License, Version 2.0 (the \"License\")",
                   "SPDX-License-Identifier: Apache-2.0"],
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License.", "SPDX-License-Identifier: MIT"],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under CC BY-NC 4.0.", "SPDX-License-Identifier: CC-BY-NC-4.0"],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under CC BY 4.0.", "SPDX-License-Identifier: CC-BY-4.0"],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.", "Licensed under the GNU General Public License, version 3.",
                "SPDX-License-Identifier: GPL-3.0-only"],
    "BSD-3-Clause": ["Licensed under the BSD 3-Clause License.", "SPDX-License-Identifier: BSD-3-Clause"],
    "ISC": ["Licensed under the ISC License.", "SPDX-License-Identifier: ISC"],
}


def known() -> list[tuple[str, str]]:
    """(licence, text): whole texts, then notices."""
    whole = [(name.removesuffix("-body"), text) for name, text in TEXTS.items()]
    return whole + [(name, line) for name, lines in NOTICES.items() for line in lines]


# Titles that some files put before the text.
TITLES: dict[str, list[str]] = {
    "MIT": ["The MIT License", "The MIT License (MIT)", "MIT License (MIT)"],
    "ISC": ["The ISC License"],
    "0BSD": ["BSD Zero Clause License", "Zero-Clause BSD"],
    "BSD-2-Clause": ["BSD 2-Clause License", "The BSD 2-Clause License", "BSD 2-Clause \"Simplified\" License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "The BSD 3-Clause License", "BSD 3-Clause \"New\" or \"Revised\" License"],
    "Zlib": ["zlib License", "The zlib License"],
}
END = "END OF TERMS AND CONDITIONS"


def _forms(name: str, text: str) -> list[str]:
    """A text as it is usually given: without what follows its terms, with items for numbers, under a title."""
    forms = [text]
    if END in text:
        forms.append(text[: text.index(END)])
        forms.append(forms[-1] + END)
    if name.startswith("BSD-"):
        forms += [f.replace("COPYRIGHT\nHOLDER OR", "COPYRIGHT\nOWNER OR").replace("COPYRIGHT HOLDER OR", "COPYRIGHT OWNER OR") for f in forms]
        forms += [re.sub(r"(?m)^\s*\d\. ", "* ", f) for f in forms]
    return forms + [f"{title}\n{f}" for title in TITLES.get(name, ()) for f in forms]


def listed() -> list[tuple[str, str]]:
    """(licence, text): those of ``known()`` and all whole texts in all their forms."""
    bodies = [("MIT", TEXTS["MIT-body"]), ("ISC", TEXTS["ISC-body"]), ("0BSD", TEXTS["0BSD"])]
    held = [(f.name.removesuffix(".txt"), f.read_text("utf-8")) for f in sorted((files(__package__) / "spdx").iterdir(), key=lambda f: f.name) if f.name.endswith(".txt")]
    return known() + [(name, form) for name, text in bodies + held for form in _forms(name, text)]
