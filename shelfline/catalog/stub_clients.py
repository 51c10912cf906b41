"""Stand-ins for the text model: pure functions of the prompt, so results can be checked."""

from __future__ import annotations

import re


def attribute_tagger():
    """Options (one per line in <att>) that occur as words of the <inp> text, or NA."""

    def call(prompt: str) -> str:
        options = re.search(r"(?s)<att>(.*?)</att>", prompt).group(1).split("\n")
        words = re.search(r"(?s)<inp>(.*?)</inp>", prompt).group(1).split(" ")
        found = [o for o in options if o and o in words]
        return f"<res>{', '.join(found) if found else 'NA'}</res>"

    return call


def option_picker():
    """Picks an option by the number of characters of title and description."""

    def call(prompt: str) -> str:
        head, rest = prompt.split("</options>", 1)
        options = re.findall(r"<item>(.*?)</item>", head)
        said = re.match(r"(?s)\n<title>(.*)</title>\n<description>(.*)</description>$", rest)
        picked = options[(len(said.group(1)) + len(said.group(2))) % len(options)] if options else "NA"
        return (
            f"<thinking>{len(options)} options</thinking>\n<category><item>{picked}</item></category>\n"
            "<confidence>high</confidence>"
        )

    return call
