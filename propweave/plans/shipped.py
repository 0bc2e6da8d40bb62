"""Programs that come with the library, as XML for plans.program.parse().

They work on records with the properties number, kind, title, year, isbn, edition, volume, person, publisher, subject
and class; a program of one's own is XML of the same form.
"""

from __future__ import annotations

from propweave.plans.program import Program, parse

_YEAR = '<regexp match="\\d{4}"/>'
_TITLE = '<case to="lower"/><replace pattern="[^\\p{L}\\d]" with=""/><substring start="0" end="$[title]"/>'


def _key(name: str, parts: dict[str, tuple[str, str]], value: str, before: str = "") -> str:
    """A program that combines a key of parts: name to (source, steps)."""
    data = "".join(f'<data source="{source}" name="{x}">{steps}</data>' for x, (source, steps) in parts.items())
    return f'<metamorph><meta><name>{name}</name></meta><vars><var name="title" value="40"/></vars><rules>{before}<combine name="key" value="{value}">{data}</combine></rules></metamorph>'


#: Match keys: records with an equal key are taken to be the same work or edition.
MATCHING = {
    "number": _key("number", {"n": ("number", "<trim/>")}, "${n}"),
    "number-inst": _key("number-inst", {"n": ("number", "<trim/>"), "i": ("_id", '<regexp match="^[^-]+"/>')}, "${i}:${n}"),
    "isbn": _key("isbn", {"b": ("isbn", "<isbn/>")}, "${b}"),
    "isbn-year": _key("isbn-year", {"b": ("isbn", "<isbn/>"), "y": ("year", _YEAR)}, "${b}-${y}"),
    "isbn-volume": _key("isbn-volume", {"b": ("isbn", "<isbn/>"), "v": ("@volume", "")}, "${b}-${v}", '<choose name="@volume"><data source="volume"><regexp match="\\d+"/></data><data source="_id"><constant value="0"/></data></choose>'),
    "isbn-edition": _key("isbn-edition", {"b": ("isbn", "<isbn/>"), "e": ("@edition", "")}, "${b}-${e}", '<choose name="@edition"><data source="edition"><regexp match="\\d+"/></data><data source="_id"><constant value="1"/></data></choose>'),
    "title-year": _key("title-year", {"t": ("title", _TITLE), "y": ("year", _YEAR)}, "${t}-${y}"),
    "title-person": _key("title-person", {"t": ("title", _TITLE), "p": ("person", _TITLE)}, "${t}-${p}"),
    "title-person-year": _key("title-person-year", {"t": ("title", _TITLE), "p": ("person", _TITLE), "y": ("year", _YEAR)}, "${t}-${p}-${y}"),
    "title-publisher-year": _key("title-publisher-year", {"t": ("title", _TITLE), "u": ("publisher", _TITLE), "y": ("year", _YEAR)}, "${t}-${u}-${y}"),
    "title-edition": _key("title-edition", {"t": ("title", _TITLE), "e": ("edition", '<regexp match="\\d+"/>')}, "${t}-${e}"),
    "title-volume": _key("title-volume", {"t": ("title", _TITLE), "v": ("volume", '<regexp match="\\d+"/>')}, "${t}-${v}"),
    "kind-title-year": _key("kind-title-year", {"k": ("kind", "<case to='upper'/>"), "t": ("title", _TITLE), "y": ("year", _YEAR)}, "${k}-${t}-${y}"),
    "person-year": _key("person-year", {"p": ("person", _TITLE), "y": ("year", _YEAR)}, "${p}-${y}"),
    "work": _key("work", {"p": ("@first", ""), "t": ("title", _TITLE)}, "${p}-${t}", f'<data source="person" name="@first"><occurrence only="1"/>{_TITLE}</data>'),
}

#: Other programs by what they are for.
OTHERS = {
    "check-edition-volume": '<metamorph><rules><combine name="both" value="${e}/${v}"><data source="edition" name="e"/><data source="volume" name="v"/></combine></rules></metamorph>',
    "too-large": '<metamorph><rules><choose name="size"><data source="contains"><count/></data><postprocess><regexp match="^\\d{$[digits],}$"/></postprocess></choose></rules></metamorph>',
    "year-kind": '<metamorph><rules><combine name="" value="${y}-${k}"><data source="year" name="y"><regexp match="\\d{4}"/></data><data source="kind" name="k"/></combine></rules></metamorph>',
    "subject-pairs": '<metamorph><rules><square name="pair" delimiter="&amp;"><data source="subject|class"><unique/></data></square></rules></metamorph>',
    "cross-walk": '<metamorph><rules><tuples name="walk" separator="="><data source="class" name="a"/><data source="subject" name="b"/></tuples></rules></metamorph>',
    "index": '<metamorph><rules><data source="title" name="t"><case to="lower"/></data><data source="person|publisher" name="n"/><data source="year" name="y"><regexp match="\\d{4}"/></data></rules></metamorph>',
    "map-marc21": '<metamorph><rules><data source="001" name="number"/><data source="245??.a" name="title"/><data source="100??.a|700??.a" name="person"/><data source="260??.c" name="year"><regexp match="\\d{4}"/></data><data source="260??.b" name="publisher"/><data source="650??.a" name="subject"/></rules></metamorph>',
    "map-mab2": '<metamorph><rules><data source="001" name="number"/><data source="331" name="title"/><data source="100|104" name="person"/><data source="425" name="year"><regexp match="\\d{4}"/></data><data source="412" name="publisher"/></rules></metamorph>',
    "map-pica": '<metamorph><rules><data source="003@.0" name="number"/><data source="021A.a" name="title"/><data source="028A.a|028C.a" name="person"/><data source="011@.a" name="year"><regexp match="\\d{4}"/></data><data source="033A.n" name="publisher"/></rules></metamorph>',
}


def program(name: str, **variables: str) -> Program:
    """A program of this library by name."""
    every = MATCHING | OTHERS
    if name not in every:
        raise ValueError(f"unknown program {name}; known: {', '.join(sorted(every))}")
    return parse(every[name], **variables)
