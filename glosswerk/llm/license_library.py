"""Further whole texts: those of the folder ``licenses``, and all known ones under and without their usual title lines."""

from __future__ import annotations

import re
from importlib import resources

from .license_texts import LICENSES

#: Files of the folder, by SPDX identifier (of the GNU licenses without "only" or "or later"), and the number of their title lines.
TITLE_LINES = {
    "Apache-2.0": 3,
    "Artistic-1.0-Perl": 1,
    "BSD-3-Clause": 0,
    "CC0-1.0": 2,
    "GFDL-1.2": 2,
    "GFDL-1.3": 2,
    "GPL-1.0": 2,
    "GPL-2.0": 2,
    "GPL-3.0": 2,
    "LGPL-2.0": 2,
    "LGPL-2.1": 2,
    "LGPL-3.0": 2,
    "MPL-1.1": 2,
    "MPL-2.0": 2,
}
#: Title lines that may precede a body; each also with "The" before it and with the identifier behind it.
TITLES = {
    "0BSD": ["0BSD License", "BSD Zero Clause License", "Zero-Clause BSD", "Zero-Clause BSD License"],
    "BSD-2-Clause": ["2-Clause BSD License", "BSD 2-Clause License", 'BSD 2-Clause "Simplified" License', "BSD License", "FreeBSD License", "Simplified BSD License"],
    "BSD-3-Clause": ["3-Clause BSD License", "BSD 3-Clause License", 'BSD 3-Clause "New" or "Revised" License', "BSD License", "Modified BSD License", "New BSD License", "Revised BSD License"],
    "ISC": ["ISC", "ISC License"],
    "MIT": ["Expat License", "MIT", "MIT License"],
    "Unlicense": ["Unlicense"],
    "Zlib": ["zlib License", "zlib/libpng License"],
}
#: What follows the terms and isn't always copied with them.
APPENDIX = r"(?m)^[ \t]*(APPENDIX: How to apply|(Appendix: )?How to Apply These Terms)"
#: Addresses of the Free Software Foundation that copies of its licenses state.
ADDRESS = r"(51 Franklin St(reet)?, Fifth Floor,\s+Boston,\s+MA\s+02110-1301,?\s+USA|59 Temple Place,? -? ?Suite 330,\s+Boston,\s+MA\s+02111-1307,?\s+USA|675 Mass Ave,\s+Cambridge,\s+MA\s+02139,?\s+USA)"
ADDRESSES = ["51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA", "51 Franklin Street, Fifth Floor, Boston, MA 02110-1301, USA", "59 Temple Place, Suite 330, Boston, MA 02111-1307 USA", "675 Mass Ave, Cambridge, MA 02139, USA"]


def _bodies(text: str) -> list[str]:
    """A text and its usual other forms: without its appendix, with other addresses."""
    out = [text]
    at = re.search(APPENDIX, text)
    if at:
        out.append(text[: at.start()])
        # the line that ends the terms is left out with the appendix, too
        out.append(re.sub(r"\s*END OF TERMS AND CONDITIONS\s*$", "\n", out[-1]))
    if re.search(ADDRESS, text):
        out += [re.sub(ADDRESS, address, t) for t in out for address in ADDRESSES]
    return out


def more_texts() -> list[tuple[str, str]]:
    """(license_id, text) of all further texts; several have one identifier."""
    out = []
    short = {i: [LICENSES[i]] for i in TITLES}
    # the grant without "/or" is as usual
    short["ISC"].append(LICENSES["ISC"].replace("and/or", "and"))
    folder = resources.files(__package__) / "licenses"
    for name, lines in TITLE_LINES.items():
        text = (folder / f"{name}.txt").read_text(encoding="utf-8")
        if name in TITLES:
            short[name].append(text)
            continue
        for whole in _bodies(text):
            out += [(name, whole), (name, re.sub(rf"^(\s*[^\n]+\n){{{lines}}}", "", whole))]
    for name, bodies in short.items():
        titled = "MIT (with its name)" if name == "MIT" else name
        heads = [f"{the}{title}{end}" for title in TITLES[name] for the in ("", "The ") for end in ("", f" ({name})")]
        out += [(name, body) for body in bodies] + [(titled, f"{head}\n\n{body}") for body in bodies for head in heads]
    return out
