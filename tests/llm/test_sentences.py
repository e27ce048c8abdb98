import random

import numpy as np
import pytest

from fleetspan.llm.sentences import STATE, SYMBOLS, sentence_units, states_of, transducer, units


def cut(text):
    doc, a, b = units([text])
    return [text[x:y] for x, y in zip(a, b, strict=True)]


@pytest.mark.parametrize(
    "parts",
    [
        ["O Sr. Silva parou a 3,5 km da Av. Central.", "Depois seguiu, às 14h30."],
        ['O motorista disse: "Acabou. Voltem amanhã." e foi embora.', '"Chega!" gritou alguém.', 'A placa dizia "Volto já."', "Nada mais."],
        ["– Vai demorar? – perguntou ela.", "Sim."],
        ["Foram vans etc.", "– Vai demorar? – perguntou ela.", "Levou 5 min. – disse ela."],
        ["não passou de novo.", "oi, tem alguém???", "valeu!"],
        ["Às vezes vem… e às vezes não.", "Parou…", "Depois andou."],
        ["Levou 20 min. na ida.", "Foram ônibus, vans etc.", "A Foo Ltda. e a Bar S.A. dividem."],
        ["J. K. Roe met Mr. Poe of the U.S. team at 9 p.m. on Sunday.", "Version 2.1.2 of x.csv broke (see fig. 3).", "Really?!"],
        ["Im 2. Halbjahr fuhr er am 3. Mai ab.", "Er sagte: „Zu. Kommen Sie morgen.“ und ging."],
        ["Il a dit : « Fermé. Revenez demain. » et il part.", "Personne n'a répondu !", "Où est la carte ?"],
        ["¿De verdad?", "¡Basta ya!", "EE. UU. aportó 3, p. ej. la tabla 3.2."],
        ["(Veja a pág. 3.)", "Fim."],
    ],
)
def test_sentences_with_blanks(parts):
    for gap in (" ", "\n", "  \r\n", "\n\n"):
        assert cut(gap.join(parts)) == parts


@pytest.mark.parametrize(
    "parts",
    [
        ["司机说：“关门了。明天来吧。”然后就开走了。", "真的吗？！", "数据又中断了……", "No.7号站台见第3.2节。", "“没有车。”检查员说。"],
        ["「本当ですか？」", "「遅い！」と乗客が叫んだ。", "雨だった……それでも待った。", "３．５キロ延びた。", "なぜ出ないのか？"],
        ["O café fechou.", "站台没有雨棚。"],
        ["O café fechou.", "왜 없습니까?"],
        ["No 1.º andar.", "ระบบหยุดทำงาน"],
    ],
)
def test_scripts_without_blanks(parts):
    assert cut("".join(parts)) == parts


def test_other_scripts():
    assert cut("ระบบหยุดทำงาน ข้อมูลล่าช้า65.7เปอร์เซ็นต์\nป้ายไม่มีหลังคา") == ["ระบบหยุดทำงาน", "ข้อมูลล่าช้า65.7เปอร์เซ็นต์", "ป้ายไม่มีหลังคา"]
    assert cut("قال السائق: «المحطة مغلقة. عودوا غدا.» ثم انصرف. هل من أحد يجيب؟ قال د. توسكا.") == ["قال السائق: «المحطة مغلقة. عودوا غدا.» ثم انصرف.", "هل من أحد يجيب؟", "قال د. توسكا."]
    assert cut('चालक ने कहा, "बंद है। कल आइए।" और गया। डॉ. वेलमार आए।') == ['चालक ने कहा, "बंद है। कल आइए।" और गया।', "डॉ. वेलमार आए।"]
    assert cut('기사는 "끝났습니다. 내일 오세요."라고 말했다. 왜 없습니까?') == ['기사는 "끝났습니다. 내일 오세요."라고 말했다.', "왜 없습니까?"]


def test_headings_lists_and_wraps():
    assert cut("1.2 Situação\n\nUma frase\nque continua aqui.\n\n- item um\n- item dois.\n- item três\n\nFim") == ["1.2 Situação", "Uma frase\nque continua aqui.", "- item um", "- item dois.", "- item três", "Fim"]
    assert cut("1. um\r\n2. dois;\r\n3. três") == ["1. um", "2. dois;", "3. três"]
    assert cut("foi na pág.\n71. Depois saiu.") == ["foi na pág.\n71.", "Depois saiu."]
    assert cut('aspas "que não fecham. Uma.\n\nOutra. Mais uma.') == ['aspas "que não fecham.', "Uma.", "Outra.", "Mais uma."]  # a stray mark quotes nothing


def test_stray_quotes_recover_at_the_next_unit():
    assert cut('An "unclosed quote here. Another sentence. And more.') == ['An "unclosed quote here.', "Another sentence.", "And more."]
    assert cut("a “stray. One. Two.") == ["a “stray.", "One.", "Two."]
    assert cut('Er sagte: „Zu. Kommen Sie morgen.“ und ging. Dann „offen. Weiter.') == ["Er sagte: „Zu. Kommen Sie morgen.“ und ging.", "Dann „offen.", "Weiter."]
    assert cut('One "two. Three "four. five." went on. End.') == ['One "two.', 'Three "four. five." went on.', "End."]
    assert cut('He left." And "he. came" back.') == ['He left."', 'And "he. came" back.']


def test_lists_that_begin_anywhere():
    assert cut("List:\n3. third item\n4. fourth") == ["List:", "3. third item", "4. fourth"]
    assert cut("see page\n71. Then it went on.") == ["see page\n71.", "Then it went on."]
    assert cut("a wrap" + " " * 900 + "\n\n" + " " * 900 + "7. item") == ["a wrap", "7. item"]


# Units marked by hand, of texts that no rule was made with: news, rules and talk in languages of the test tables and beyond.
HELD_OUT = [
    ["Dept. of Health staff met Lt. Fox on Jan. 5 at 3 p.m. sharp.", "About 4.5 million people (see Fig. 2) live there.", "“Is it far?” asked Capt. Lee.", "No."],
    ["Prof. Anna Nowak mieszka przy ul. Długiej 5, tj. w centrum.", "Lubi np. kawę.", "Czy to prawda?"],
    ["Dhr. De Vries kwam o.a. langs bij mevr. Bakker.", "Daarna ging hij weg.", "Wat nu?"],
    ["La Sra. Gómez llegó a las 8.30 h. con su hijo.", "¿Quién lo sabe?", "Nadie, p. ej., lo vio."],
    ["M. Durand a dit : « Non. Jamais. » puis il est sorti.", "Quelle heure est-il ?"],
    ["Die Fa. Müller, d.h. der Inhaber, zahlt am 3. Oktober ca. 40 Euro.", "Warum?", "Das weiß z. B. niemand."],
    ["Il sig. Rossi abita qui.", "Dove vai?", "Non lo so!"],
    ["今天下雨了。", "你带伞了吗？", "他说：“没有。算了。”就走了。"],
    ["雨が降った。", "「傘は？」と聞いた。", "誰も答えなかった。"],
    ["Η μέρα ήταν ζεστή.", "Πήγε σπίτι.", "Гости ушли.", "Стало тихо."],
    ["오늘은 춥다.", "어디 가니?", "집에 간다."],
    ["आज बारिश हुई।", "तुम कहाँ हो?"],
    ["كان اليوم حارا.", "إلى أين تذهب؟", "لا أعرف."],
]


def test_held_out_texts():
    found = true = both = 0
    for parts in HELD_OUT:
        gap = "" if ord(parts[0][-1]) > 0x3000 else " "
        got, want = cut(gap.join(parts)), parts
        found, true, both = found + len(got), true + len(want), both + len(set(got) & set(want))
    assert both / true >= 0.9 and both / found >= 0.8, (found, true, both)  # 36 of 39 found among 42 units


def test_blank_and_odd_texts():
    assert units([]) [0].size == 0
    for t in ("", " ", "\n\n\t", "\xa0"):
        assert cut(t) == []
    assert cut("...") == ["..."] and cut("a") == ["a"] and cut(" a ") == ["a"] and cut("?!") == ["?!"]
    assert len(cut("Uma frase. " * 50_000)) == 50_000
    assert cut("a" * 100_000) == ["a" * 100_000]


def test_blocks_and_scan_equal_one_walk():
    nxt, _ = transducer()
    r = random.Random(2)
    for _ in range(60):
        sym = np.array([r.randrange(len(SYMBOLS)) for _ in range(r.randrange(1, 900))], dtype=np.uint8)
        s, want = STATE["beg"], [STATE["beg"]]
        for x in sym:
            s = int(nxt[s, x])
            want.append(s)
        for block in (1, 7, 64, 256):
            assert states_of(sym, block).tolist() == want


def test_units_do_not_depend_on_neighbours_and_keep_all_text():
    r = random.Random(4)
    al = 'aB. !?…"“”„«»「」。\n\r-–1)(;:ไ日とé'
    texts = ["".join(r.choice(al) for _ in range(r.randrange(0, 80))) for _ in range(400)]
    doc, a, b = units(texts)
    for i, t in enumerate(texts):
        own = [(int(x), int(y)) for d, x, y in zip(doc, a, b, strict=True) if d == i]
        _, x1, y1 = units([t])
        assert own == list(zip(x1.tolist(), y1.tolist(), strict=True))
        assert all(not t[x].isspace() and not t[y - 1].isspace() for x, y in own)
        assert "".join("".join(t[x:y].split()) for x, y in own) == "".join(t.split())
        assert all(p[1] <= q[0] for p, q in zip(own[:-1], own[1:], strict=True))


def test_frame(spark):
    rows = [(1, "Uma. Duas."), (2, None), (3, ""), (None, "Oi. Tchau."), (1, "Uma. Duas.")]
    df = spark.createDataFrame([(*r, 5) for r in rows], "doc_id bigint, text string, start_char int")
    got = sorted((r["doc_id"] or 0, r["start_char"], r["end_char"]) for r in sentence_units(df).collect())
    assert got == [(0, 0, 3), (0, 4, 10), (1, 0, 4), (1, 0, 4), (1, 5, 10), (1, 5, 10)]
    assert sentence_units(df.limit(0)).count() == 0
