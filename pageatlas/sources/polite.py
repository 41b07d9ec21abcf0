"""A fetcher for ``Engine.crawl`` around any transport: robots rules, retries, conditional requests, delay.

``transport(url, headers)`` gives {status, headers, body, url}, or raises ConnectionError or TimeoutError.
One instance serves the hosts of one task in turn, so there is one request a host at a time.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from urllib.parse import urlsplit
from urllib.robotparser import RobotFileParser

#: Statuses that are tried again, how often, and the accepted types.
RETRIED, ATTEMPTS, ACCEPT = frozenset({429, 500, 502, 503, 504}), 3, "text/html,*/*;q=0.8"


class PoliteFetcher:
    def __init__(self, transport: Callable[[str, dict], dict], user_agent: str, host_delay: float = 1.0, retry_wait: float = 1.0):
        self.transport, self.user_agent, self.host_delay, self.retry_wait = transport, user_agent, host_delay, retry_wait
        self._robots: dict[str, RobotFileParser | None] = {}

    def allowed(self, url: str) -> bool:
        """Robots rules of the url's origin, read once: 401 and 403 forbid all; no rules, or none to be had, allow."""
        parts = urlsplit(url)
        origin = f"{parts.scheme}://{parts.netloc}"
        if origin not in self._robots:
            rules = None
            try:
                got = self.transport(f"{origin}/robots.txt", {"User-Agent": self.user_agent})
                lines = got.get("body", "").splitlines() if got["status"] == 200 else ["User-agent: *", "Disallow: /"] if got["status"] in (401, 403) else None
                if lines is not None:
                    rules = RobotFileParser()
                    rules.parse(lines)
            except (ConnectionError, TimeoutError):
                pass
            self._robots[origin] = rules
        rules = self._robots[origin]
        return rules is None or rules.can_fetch(self.user_agent, url)

    def get(self, url: str, headers: dict) -> dict:
        """Up to ATTEMPTS tries with growing waits; the last answer stands, the last failure is raised."""
        for n in range(ATTEMPTS):
            last = n + 1 == ATTEMPTS
            try:
                got = self.transport(url, headers)
                if got["status"] not in RETRIED or last:
                    return got
            except (ConnectionError, TimeoutError):
                if last:
                    raise
            time.sleep(self.retry_wait * 2**n)
        raise AssertionError

    def __call__(self, base: str, etag: str | None, last_modified: str | None) -> dict:
        if not self.allowed(base):
            return {"error": "robots"}
        headers = {"User-Agent": self.user_agent, "Accept": ACCEPT}
        if etag:
            headers["If-None-Match"] = etag
        if last_modified:
            headers["If-Modified-Since"] = last_modified
        try:
            got = self.get(base, headers)
        finally:
            time.sleep(self.host_delay)
        h = {k.lower(): v for k, v in got.get("headers", {}).items()}
        return {
            "status": got["status"], "body": got.get("body"), "final_url": got.get("url", base), "content_type": h.get("content-type"),
            "etag": h.get("etag"), "last_modified": h.get("last-modified"), "robots_tag": h.get("x-robots-tag"), "headers": h,
        }
