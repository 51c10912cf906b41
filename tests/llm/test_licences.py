"""License scan against a comparison of all blocks with all templates."""

import random
import re

from shelfline.llm import licences as L


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def by_hand(text, templates, percent=80, phrases=L.PHRASES):
    words = words_of(text)
    places = [(i, label) for p, label in phrases.items() for i in range(len(words)) if words[i: i + len(p.split())] == p.split()]
    labels, score = {label for _, label in places}, 1.0 if places else 0.0
    base = ",".join(sorted(labels))
    for label, names, body in templates:
        want, k = set(L.template_words(body)), len(L.template_words(body))
        for i in range(max(len(words) - k + 1, 1)):
            have = set(words[i: i + k])
            if 100 * len(have & want) >= percent * len(want) and set(L.template_words(names)) <= have:
                labels.add(label)
                score = max(score, len(have & want) / len(want))
    at = [i for i, _ in places]
    return (len(words), len(places), min(at, default=None), max(at, default=None), base, ",".join(sorted(labels)), score)


def test_random_blocks_equal_brute_force(spark):
    rng = random.Random(11)
    bodies = [[rng.choice("abcdefghijklmnopqrstuvwxyz") + str(rng.randint(0, 3)) for _ in range(rng.choice([1, 2, 5, 12]))] for _ in range(8)]
    templates = [(f"t{k}", " ".join(rng.sample(body, min(k % 3, len(body)))), " ".join(body)) for k, body in enumerate(bodies)]
    data = []
    for i in range(200):
        lines = []
        for _ in range(rng.randint(0, 4)):
            body = rng.choice(templates)[2].split()
            kept = [w.upper() if rng.random() < 0.3 else w for w in body if rng.random() < 0.85]
            noise = [rng.choice("abcdefghij") + str(rng.randint(0, 3)) for _ in range(rng.randint(0, 6))]
            line = kept + noise
            if rng.random() < 0.5:
                rng.shuffle(line)
            lines.append(rng.choice([" ", "-", ", ", "\n"]).join(line))
        lines += rng.choice([[], ["under the MIT license"], ["Apache License, Version 2; CC BY-NC"], ["cc by", "nc"], ["…é日本 cc by nc"]])
        data.append((i, "\n".join(lines)))
    data += [(900, None), (901, ""), (902, "cc by nc " * 3)]
    df = spark.createDataFrame(data, "doc_id bigint, text string").repartition(5)
    got = {r.doc_id: tuple(r)[1:] for r in L.decide(df, templates=templates).collect()}
    for doc_id, text in data:
        assert got[doc_id] == by_hand(text, templates), text


def test_phrases_and_notices(spark):
    data = [
        (1, "Released under the MIT License."), (2, "Apache License, Version 2.0"), (3, "text\nThis is licensed under the GNU General Public License, version 3."),
        (4, "Redistribution and use in source and binary forms, with or without modification, are permitted, provided the following conditions are met."),
        (5, "the license of the mit"), (6, "Licensed\nunder\nthe\nApache License, Version\n2"),
    ]
    got = {r.doc_id: r for r in L.decide(spark.createDataFrame(data, "doc_id bigint, text string")).collect()}
    assert (got[1].base_labels, got[1].first_word, got[1].score) == ("mit", 1, 1.0) and got[2].base_labels == "apache-2"
    assert got[3].labels == "gpl-3" and got[3].base_labels == "" and 0.8 <= got[3].score <= 1.0
    assert got[4].labels == "bsd" and got[5].labels == "" and got[5].score == 0.0
    assert got[6].base_labels == "apache-2" and got[6].first_word == 3


def test_the_words_that_name_a_license_decide(spark):
    notice = L.TEMPLATES[[t[0] for t in L.TEMPLATES].index("mit") + 1][2].split()
    wrapped = "\n".join(" * " + " ".join(notice[i: i + 8]) for i in range(0, len(notice), 8))
    scattered = "They released " + "word " * 40 + "under the new roof " + "word " * 40 + "the MIT campus " + "word " * 40 + "license"
    data = [
        (1, "Released under the BSD License."), (2, "This program is made available under the terms of the Eclipse Public License, Version 2.0"),
        (3, "Released under the Apache License, Version 2.0"), (4, wrapped), (5, "Licensed under the GNU General Public License, version 2"),
        (6, scattered), (7, "prose " * 300 + wrapped + " prose" * 300), (8, L.TEMPLATES[-2][2]),
    ]
    got = {r.doc_id: r.labels for r in L.decide(spark.createDataFrame(data, "doc_id bigint, text string")).collect()}
    assert len(notice) > 16 and wrapped.count("\n") >= 2
    assert got == {1: "", 2: "", 3: "apache-2", 4: "mit", 5: "", 6: "", 7: "mit", 8: "mit"}


def test_awkward_rows_and_empty_tables(awkward, nothing):
    out = L.decide(awkward)
    assert out.count() == awkward.count() and out.where("labels is null or score is null").count() == 0
    assert L.decide(nothing).count() == 0
