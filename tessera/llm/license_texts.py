"""Texts by which licenses are told: whole short licenses, standard notices of long ones, and one-line notices by rule."""

from __future__ import annotations

# Wording of public licenses.
_MIT_GRANT = 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software'
_BSD_OPENING = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
_BSD_SOURCE = "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
_BSD_BINARY = "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_NAMES = "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_END = 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'
_ISC_GRANT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_ISC_KEEP = ", provided that the above copyright notice and this permission notice appear in all copies"
_ISC_END = '. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'
WHOLE = {
    "MIT": _MIT_GRANT,
    "MIT-text": _MIT_GRANT + ', and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
    "BSD": _BSD_OPENING,
    "BSD-2-Clause-text": f"{_BSD_OPENING} 1. {_BSD_SOURCE} 2. {_BSD_BINARY} {_BSD_END}",
    "BSD-3-Clause-text": f"{_BSD_OPENING} 1. {_BSD_SOURCE} 2. {_BSD_BINARY} 3. {_BSD_NAMES} {_BSD_END}",
    "ISC-text": _ISC_GRANT + _ISC_KEEP + _ISC_END,
    "0BSD-text": _ISC_GRANT + _ISC_END,
    "Zlib-text": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.",
    "Unlicense-text": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "BSL-1.0-text": 'Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:',
    "Apache-2.0": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0',
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "MPL-1.1": "The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.mozilla.org/MPL/",
    "EPL-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "EPL-1.0": "All rights reserved. This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
}
# The licenses of one family, by identifier: name, version.
_GNU = {
    "GPL-2.0": ("General Public License", "2"), "GPL-3.0": ("General Public License", "3"), "LGPL-2.0": ("Library General Public License", "2"),
    "LGPL-2.1": ("Lesser General Public License", "2.1"), "LGPL-3.0": ("Lesser General Public License", "3"), "AGPL-3.0": ("Affero General Public License", "3"),
}
_NAMES = {
    "MIT": "MIT License", "ISC": "ISC License", "0BSD": "Zero-Clause BSD License", "BSD-2-Clause": "BSD 2-Clause License", "BSD-3-Clause": "BSD 3-Clause License", "Zlib": "zlib License",
    "Apache-2.0": "Apache License, Version 2.0", "Apache-1.1": "Apache License, Version 1.1", "MPL-1.1": "Mozilla Public License, version 1.1", "MPL-2.0": "Mozilla Public License, version 2.0",
    "EPL-1.0": "Eclipse Public License, version 1.0", "EPL-2.0": "Eclipse Public License, version 2.0", "BSL-1.0": "Boost Software License, Version 1.0", "Artistic-2.0": "Artistic License, version 2.0",
    "EUPL-1.2": "European Union Public License, version 1.2", **{k: f"GNU {n}, version {v}" for k, (n, v) in _GNU.items()},
}
# Families that are named without a version, and the forms of a one-line notice.
_UNVERSIONED = {"BSD": "BSD License"}
_FORMS = {
    "released": "Released under the", "licensed": "Licensed under the", "work": "This work is licensed under the", "project": "This project is licensed under the",
    "distributed": "Distributed under the", "terms": "Distributed under the terms of the",
}
_RIGHTS = {"BY": "Attribution", "SA": "ShareAlike", "NC": "NonCommercial", "ND": "NoDerivatives"}
_COMMONS = {"3.0": "3.0 Unported", "4.0": "4.0 International"}


def templates() -> dict[str, str]:
    """All templates by name: an identifier, with the sort of text behind it where there are several."""
    out = dict(WHOLE)
    for key, (name, version) in _GNU.items():
        thing = "library" if key.startswith("LGPL") else "program"
        out[key] = f"This {thing} is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version."
        terms = f"under the terms of the GNU {name} version {version} as published by the Free Software Foundation."
        short = key.split("-")[0]
        out[f"{key}-only-notice"] = f"This {thing} is free software; you can redistribute it and/or modify it {terms}"
        out[f"{key}-terms-only-notice"] = terms
        for said in ("Licensed", "Released"):
            out[f"{key}-{said.lower()}-joined-notice"] = f"{said} under the {short}v{version}."
            out[f"{key}-{said.lower()}-apart-notice"] = f"{said} under the GNU {short} v{version}."
    for key, name in (_NAMES | _UNVERSIONED).items():
        first = "work" if key in _GNU else "licensed" if key.startswith("Apache") else "released"
        for form, said in _FORMS.items():
            out[f"{key}-notice" if form == first else f"{key}-{form}-notice"] = f"{said} {name}."
    for key in _NAMES:
        out[f"{key}-id"] = f"SPDX-License-Identifier: {key}"
    for parts in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND"):
        for version, said in _COMMONS.items():
            name = "-".join(_RIGHTS[p] for p in parts.split("-"))
            statement, short = f"This work is licensed under a Creative Commons {name} {said} License.", f"Licensed under CC {parts} {version}."
            key = f"CC-{parts}-{version}"
            out |= {key: statement, f"{key}-short-notice": short}
            out[f"{key}-id"] = f"SPDX-License-Identifier: {key}"
    return out


#: Ends of template names that say which text of a license a template is, longest first.
_SORTS = sorted([*(f"-{form}-notice" for form in _FORMS), *(f"-{said}-{how}-notice" for said in ("licensed", "released") for how in ("joined", "apart")), "-terms-only-notice", "-only-notice", "-short-notice", "-notice", "-text", "-id"], key=len, reverse=True)


def license_of(name: str) -> str:
    """Identifier of the license that a template stands for; a family's, without a version, where its text names none."""
    tail = next((t for t in _SORTS if name.endswith(t)), "")
    return name.removesuffix(tail)
