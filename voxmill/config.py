"""Which site the pages come from. A user sets these to the site they collect."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Site:
    name: str = "examplereviews"
    base_url: str = "https://reviews.example.org"
    # Regular expression an item URL's path must end with, and the marker of item slugs.
    item_path: str = r"-c\d+$"
    item_marker: str = "-c"
    default_category: str = "appliances-electronics-and-technology"

    @property
    def host(self) -> str:
        return self.base_url.split("://", 1)[1].split("/", 1)[0].replace("www.", "")


DEFAULT_SITE = Site()
