"""Notices as files carry them in their head, and whole licence texts."""

from __future__ import annotations

from pathlib import Path

_GNU = (
    "This {what} is free software{colon} you can redistribute it and/or modify it under the terms of the {name}"
    " as published by the Free Software Foundation{comma} either version {version} of the License, or (at your"
    " option) any later version. This {what} is distributed in the hope that it will be useful, but WITHOUT ANY"
    " WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the"
    " {name} for more details. You should have received a copy of the {name} along with this {what}"
)
_SEE = ". If not, see <https://www.gnu.org/licenses/>."
_WRITE = (
    "; if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA."
)


def _gnu(name: str, version: str, what: str, end: str) -> str:
    return _GNU.format(name=name, version=version, what=what, colon=":", comma=",") + end


def whole_texts() -> list[tuple[str, str]]:
    """Licence and text, of the files in licence_texts."""
    folder = Path(__file__).parent / "licence_texts"
    return [(p.stem, p.read_text(encoding="utf-8")) for p in sorted(folder.glob("*.txt"))]


def _body(text: str, start: str) -> str:
    return text[text.index(start) :]


WHOLE = whole_texts()
_OF = dict(WHOLE)
NOTICES = [
    ("Apache-2.0", _body(_OF["Apache-2.0"], '   Licensed under the Apache License, Version 2.0 (the "License");')),
    ("GPL-2.0", _gnu("GNU General Public License", "2", "program", _WRITE)),
    ("GPL-2.0", _gnu("GNU General Public License", "2", "program", _SEE)),
    ("GPL-3.0", _gnu("GNU General Public License", "3", "program", _SEE)),
    ("AGPL-3.0", _gnu("GNU Affero General Public License", "3", "program", _SEE)),
    ("LGPL-2.1", _gnu("GNU Lesser General Public License", "2.1", "library", _WRITE)),
    ("LGPL-2.1", _gnu("GNU Lesser General Public License", "2.1", "library", _SEE)),
    ("LGPL-3.0", _gnu("GNU Lesser General Public License", "3", "library", _SEE)),
    ("LGPL-3.0", _gnu("GNU Lesser General Public License", "3", "program", _SEE)),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was"
        " not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    ("MIT", _body(_OF["MIT"], "Permission is")),
    ("BSD-2-Clause", _body(_OF["BSD-2-Clause"], "Redistribution and")),
    ("BSD-3-Clause", _body(_OF["BSD-3-Clause"], "Redistribution and")),
]
