from packwright.functions import html as H


def test_equal_pages_of_a_batch_are_parsed_once(monkeypatch):
    deep = "<div>" * 2000 + "<h3>Other</h3>"
    named = "<h2>Methods</h2><p>caf&eacute; en</p>"
    pages = [deep, named, None, deep, "<h2>Methods</h2><![foo x ]><p>x", deep, named, None]
    expected = [H.judged_sections(p, H.METHODS_HEADING, H.RESULTS_HEADING) for p in pages]
    seen = []
    judged = H.judged_sections
    monkeypatch.setattr(H, "judged_sections", lambda p, m, r: seen.append(p) or judged(p, m, r))
    assert H.judged_pages(pages, H.METHODS_HEADING, H.RESULTS_HEADING) == expected
    assert sorted(seen, key=str) == sorted(set(pages), key=str)
    assert expected[1][1] == "café en" and expected[4][4] == H.QUARANTINED
