from pageatlas.sources.polite import PoliteFetcher


def fetcher(answers, log):
    def transport(url, headers):
        log.append((url, headers.get("If-None-Match")))
        a = answers[url].pop(0) if isinstance(answers[url], list) else answers[url]
        if isinstance(a, Exception):
            raise a
        return a

    return PoliteFetcher(transport, "agent", host_delay=0, retry_wait=0)


def test_robots_retries_and_conditional_requests():
    log = []
    f = fetcher(
        {
            "https://a.example/robots.txt": {"status": 200, "body": "User-agent: *\nDisallow: /no"},
            "https://a.example/x": [{"status": 503}, ConnectionError(), {"status": 200, "body": "b", "headers": {"ETag": "e", "Content-Type": "text/html"}}],
            "https://b.example/robots.txt": {"status": 403},
            "https://c.example/robots.txt": TimeoutError(),
            "https://c.example/": [{"status": 500}] * 3,
        },
        log,
    )
    assert f("https://a.example/no", None, None) == {"error": "robots"}
    got = f("https://a.example/x", "old", None)
    assert (got["status"], got["etag"], got["content_type"]) == (200, "e", "text/html")
    assert [e for u, e in log if u.endswith("/x")] == ["old"] * 3 and sum(u.endswith("a.example/robots.txt") for u, _ in log) == 1
    assert f("https://b.example/", None, None) == {"error": "robots"}
    assert f("https://c.example/", None, None)["status"] == 500
