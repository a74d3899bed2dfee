import hashlib
import random
import re

import pytest

from feedlens.llm import secrets as sc

ASSIGN = re.compile(r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD])|(?:[pP][aA][sS][sS][wW][dD])|"""
                    r"""(?:[sS][eE][cC][rR][eE][tT])|(?:[tT][oO][kK][eE][nN])|"""
                    r"""(?:[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?"""
                    r"""([A-Za-z0-9+/_.=-]+)""")


def brute(text):
    """Base spans by the patterns as given, with failing matches dropped afterwards."""
    text = text or ""
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    found += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text)
              if len(m.group()) >= 20]
    found += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24]
    return sorted(found, key=lambda s: (s[1], sc.KINDS.index(s[0])))


def check(df, pairs):
    got = sorted(map(tuple, df.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256")
                     .collect()), key=str)
    expected = []
    for i, text in pairs:
        spans = brute(text)
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        expected.append((i, *(sum(s[0] == k for s in spans) for k in sc.KINDS[:3]),
                         hashlib.sha256(joined.encode()).hexdigest()))
    assert got == sorted(expected, key=str)


def test_whole_table(spark, sf_dir, corpus):
    df = sc.op8_secret_scan(spark, sf_dir)
    check(df, corpus)
    for r in df.collect():
        kinds = [s.split(":")[0] for s in r["spans"].split(",") if s]
        assert [kinds.count(k) for k in sc.KINDS[:3]] == [r["n_assign"], r["n_access"], r["n_hex"]]


def test_random_texts_and_edges(edge_docs, make_docs):
    from tests.llm.conftest import EDGE_TEXTS

    check(sc.scan_report(edge_docs), EDGE_TEXTS)
    assert sc.scan_report(edge_docs.limit(0)).count() == 0
    draw = random.Random(8)
    parts = ["token", "SECRET", "Api_Key", "apikey", " ", "=", ":", "\"", "'", "abc", "deadbeef01",
             "AKIA", "ABCDEFGH12", "ſecret", "K", "é", "\n", "passwd", "token=secret=abcdefgh"]
    pairs = [(i, "".join(draw.choices(parts, k=draw.randrange(25)))) for i in range(400)]
    check(sc.scan_report(make_docs(*pairs)), pairs)


@pytest.mark.parametrize(("text", "expected"), [
    ('DB_PWD = "s3cr3tP@ssw0rd!"', ["s3cr3tP@ssw0rd!"]),
    ('k = "aZ19xQ77Lm0p"\nauth_key = k', ["aZ19xQ77Lm0p"]),
    ('a = "aZ19xQ77"\nb = a + "Lm0pQ3"\nsession_credential = b', ["aZ19xQ77", "Lm0pQ3"]),
    ("<privateKey>Tr0ub4dor&3x9</privateKey>", ["Tr0ub4dor&3x9"]),
    ("mysql --db-pass Zx9Qw8Er7Ty -h", ["Zx9Qw8Er7Ty"]),
    ('{"privateKey": "MIIEvQIBADANBgkq"}', ["MIIEvQIBADANBgkq"]),
    ('cfg["db_credential"] = "q1w2e3r4t5"', ["q1w2e3r4t5"]),
    ("the key: a small thing to say", []), ("max_tokens = 4096", []),
    ('public_key = "ssh-rsa-AAAAB3Nza"', []), ("bearer = os.environ['X']", []),
    ('credential = "changeme"', []), ('title = "aZ19xQ77Lm0p"', []), ("12:30 = noon", []),
    ("run --x--db-pass Zx9Qw8Er7Ty", ["Zx9Qw8Er7Ty"]), ("db_pwd = fetch:now(", []),
    ("see http://host/key=1", []), ('pwd = "${DB_PWD}"', []), ("a = b = c", []),
])
def test_lexed_literals(text, expected):
    assert [text[s.start:s.end] for s in sc.secret_spans(text) if s.kind == "lexed"] == expected


def test_masking(make_docs):
    docs = make_docs((1, 'x token = "abcdef123" y'), (2, "clean text"), (3, None),
                     (4, "deadbeef" * 4 + " AKIA" + "A1" * 8))
    rows = {r["doc_id"]: r for r in sc.mask_secrets(docs).collect()}
    assert sc.mask_secrets(docs).columns == docs.columns
    assert rows[1]["text"] == 'x token = "[secret]" y' and rows[1]["n_chars"] == 22
    assert rows[2]["text"] == "clean text" and rows[3]["text"] is None
    assert rows[4]["text"] == "[secret] [secret]"


def test_long_lines_take_linear_time():
    import time
    for text in ("a=" * 60000, '="' * 60000, "<" * 100000, "x" * 200000 + "=", "--a" * 50000,
                 "a:" * 60000 + "(", "</a>" * 50000, "--a " * 50000, "a='" * 50001):
        began = time.time()
        sc.secret_spans(text)
        assert time.time() - began < 5


def lexed(text):
    return [text[s.start:s.end] for s in sc.secret_spans(text) if s.kind == "lexed"]


def test_chained_constants_stay_small():
    import time
    text = 'a0 = "abcdEF12"\n' + "".join(f"a{i} = a{i - 1} + a{i - 1}\n" for i in range(1, 41))
    began = time.time()
    assert lexed(text + "db_pwd = a40\n") == ["abcdEF12"]
    fibonacci = 'b0 = "Zx9"\nb1 = "kQ7!"\n' + "".join(
        f"b{i} = b{i - 1} + b{i - 2}\n" for i in range(2, 300))
    assert lexed(fibonacci + 'admin_pwd = b9\n') == ["Zx9", "kQ7!"]
    assert time.time() - began < 2
    long = "".join(f'p{i} = "{"Ab1!" * 400}{i}"\n' for i in range(5))
    assert len(lexed(long + "db_pwd = p0 + p1 + p2 + p3 + p4\n")) == 5


def test_long_chains_take_linear_time_and_memory():
    import time
    import tracemalloc
    n = 8000
    plain = 'a0 = "Zq8!kkW0"\n' + "".join(f'a{i} = a{i - 1} + "Zq8!kk{i}"\n' for i in range(1, n))
    judged = plain.replace("a", "pwd")
    tokens = "".join(f'token = "Zq8kkW{i}"\npwd{i} = "Ab3!xY{i}"\n' for i in range(n))
    for text, count in ((plain + f"db_pwd = a{n - 1}\n", n), (judged, n), (tokens, n)):
        tracemalloc.start()
        began = time.time()
        assert len(lexed(text)) == count
        assert time.time() - began < 10 and tracemalloc.get_traced_memory()[1] < 100 << 20
        tracemalloc.stop()


def test_literals_of_one_kind_and_with_blanks():
    for text, value in (('passphrase = "kqzvwhtrplmx"', "kqzvwhtrplmx"),
                        ('DB_PASSPHRASE = "8842317760"', "8842317760"),
                        ('db_pwd = "myS3cr3t!Zq9"', "myS3cr3t!Zq9"),
                        ('admin_pwd = "correct horse battery 9X!"', "correct horse battery 9X!"),
                        ('db_pwd = "exampleQ7!vv"', "exampleQ7!vv")):
        assert lexed(text) == [value]
    for text in ('passphrase = "your-passphrase-here"', 'db_pwd = "my_password"',
                 'db_pwd = "enter your password here"', 'db_pwd = "${DB_PWD}"',
                 'db_pwd = "changeme"', 'passphrase = "xxxxxxxxxx"', 'db_pwd = "plain words here"',
                 'pwd_hint = "Zq8!kkW0p"'):
        assert lexed(text) == []


def test_random_programs_against_an_evaluator():
    """Programs of constants, references and sums; every literal that a sensitive name is made of
    must be found, and nothing else."""
    draw = random.Random(17)
    for _ in range(300):
        lines, parts, value, expected = [], {}, {}, set()
        at = 0
        for i in range(draw.randrange(1, 9)):
            name = draw.choice(["db_pwd", "alpha", "beta", "passphrase", "colour"]) + str(i)
            terms, own, whole = [], [], ""
            for _ in range(draw.randrange(1, 4)):
                if parts and draw.random() < .4:
                    ref = draw.choice(sorted(parts))
                    terms.append(ref)
                    own += parts[ref]
                    whole += value[ref]
                else:
                    literal = "".join(draw.choices("abXY01!?", k=draw.randrange(1, 9)))
                    start = at + len(f"{name} = ") + len(" + ".join([*terms, '"']))
                    terms.append(f'"{literal}"')
                    own.append((start, start + len(literal)))
                    whole += literal
            line = f"{name} = " + " + ".join(terms)
            parts[name], value[name] = list(dict.fromkeys(own)), whole
            if sc.name_score(name) * sc.literal_score(whole, True) >= sc.THRESHOLD:
                expected |= set(own)
            lines.append(line)
            at += len(line) + 1
        text = "\n".join(lines)
        found = {(s.start, s.end) for s in sc.secret_spans(text) if s.kind == "lexed"}
        assert found == expected, text
