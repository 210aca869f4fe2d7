"""Credentials in code: a conditional random field labels the tokens of suspicious lines, its spans are masked.

A line is looked at when it holds a word of secrets or logins, a known key form (``TRIGGERS``, one Aho-Corasick pass over
the whole text), or a literal that mixes letters and digits and is no numbered word or path.  Its tokens get the labels O, B (a value
begins) and I (it goes on, perhaps as a further piece); the Viterbi spans alone say which characters are masked.
The chain was trained on lines made by ``examples`` (see ``__main__``).
"""

from __future__ import annotations

import base64
import random
import re
import string
from functools import lru_cache
from pathlib import Path

import ahocorasick

from siltloom.llm.crf import Chain, train

MODEL = Path(__file__).with_name("secrets_crf.json")
#: A key block to its end mark, over no code; one that breaks off goes as far as its lines of key material do.
_PEM = r"-----BEGIN [A-Z0-9 ]+-----(?:[^;(){}<>]*?-----END [A-Z0-9 ]+-----|(?:(?:\\[nr]|['\"`+\s])*[A-Za-z0-9+/=]{24,}+)*+)"
#: Parts of words (lower case) that make a line suspicious.
TRIGGERS = "passw pwd passphrase passcode secret token apikey api_key appkey app_key signkey sign_key accesskey access_key aeskey aes_key hmac privatekey private_key authkey auth_key encryptionkey clientkey masterkey licensekey servicekey sharedkey sshkey credential authori bearer basic\x20 jwt cookie 密码 口令 密钥 令牌 凭证 秘钥 パスワード login signin authenticate -----begin akia ghp_ gho_ ghu_ ghs_ ghr_ _live_ jdbc:".split(" ")
_LITERAL = re.compile(r"['\"`]([^'\"`\s]{8,})['\"`]|://[^/\s'\"`]*:[^/\s'\"`]*@|\b(?:pass|auth|[kK]ey)\b(?=\s*['\"]?\s*[:=：])|[a-z]Pass\b|_AUTH\b")
#: Letters with digits, but no word or path with a number behind it; long hexadecimal numbers.
_MIX = re.compile(r"(?=.*[A-Za-z])(?=.*\d)(?![A-Za-z]+(?:[_./-][A-Za-z]+)*[_.-]?\d+(?:\.[a-z]+)?$)|(?:.*[^0-9a-f])?[0-9a-f]{24,}")
_TOKEN = re.compile(
    rf"(?P<pem>{_PEM})|(?P<url>[A-Za-z][\w+.-]*://[^\s'\"`<>\\]+)|(?P<data>data:[\w/+.-]+;base64,[A-Za-z0-9+/=]*)|(?P<hole>\$\{{[^{{}}'\"`]*\}})|(?P<quote>['\"`])|(?P<open>//|/\*|\*/)"
    rf"|(?P<word>(?:(?!\$\{{)[^\s'\"`,;(){{}}\[\]:=<>：]|\\.){{8,}}?={{1,2}}(?=['\"`\s]|$)|(?:(?!\$\{{)[^\s'\"`,;(){{}}\[\]:=<>：])+)|(?P<sign>[=!]==?|[,;(){{}}\[\]:=<>：])",
    re.S,
)
_CODE_WORD = re.compile(r"[\w$]+")
_CRED_URL = re.compile(r"([A-Za-z][\w+.-]*://)([^:/\s@]*)(:)(.+)(@)([\w.-]+(?::\d+)?(?:[/?].*)?)$")
_PARAM = re.compile(r"([?&])([\w.-]+)(=)([^&#]+)")
_SPLIT = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+|[一-鿿]+|[ァ-ヶー]+")
#: Words that name secrets, and words that name what only looks like one.
SECRET_WORDS = frozenset("password passwd pwd pass passphrase passcode secret token apikey auth authorization authorize ak sk credential credentials jwt bearer basic hmac aes signin authenticate login 密码 口令 密钥 令牌 凭证 秘钥 パスワード".split())
KEY_BEFORE = frozenset("api app sign access aes des hmac private auth encryption encrypt client master store license service shared ssh rsa secret signing set".split())
PUBLIC_WORDS = frozenset("checksum commit sha md digest hash etag revision request trace uuid guid icon image font color colour public fingerprint version build hint rule regex pattern placeholder label title template type name policy length min max error msg message tip".split())
#: Calls whose second literal is a password.
ENTRY_CALLS = frozenset("login signin logon authenticate signup".split())
CONN_WORDS = frozenset("jdbc conn connect connection open dsn datasource admin input login".split())
_PLACEHOLDER = re.compile(
    r"(?:.*(?:your|example|sample|dummy|changeme|change_me|placeholder|redacted|todo|fixme|replace|insert|enter|here|test_?key|填写|请输入|替换).*|<.*>?|\W*|(.)\1{3,}|[xX*.#_-]{4,}.*|\$\{.*|\{\{.*|%\w+%?|\$[A-Z_]+|null|none|undefined|true|false|bearer|basic|(?:1234567890?|abcdefg?h?|qwerty)\w*)$",
    re.I,
)
_CAMEL = re.compile(r"[a-z]+(?:[A-Z][a-z]+)*|(?:[A-Z][a-z]+)+|[A-Z]+(?:_[A-Z]+)*|[a-z]+(?:[_.-][a-z]+)*")
_WORDPW = re.compile(r"[A-Z]?[a-z]+[@#_\-&%!?*.$+=]?\d{2,}[!?*@#$%&+=.]?")


def shape(t: str) -> str:
    """What a token looks like, as one of a few names."""
    n = len(t)
    if n < 4:
        return "short"
    if t.startswith("-----BEGIN"):
        return "pempriv" if "PRIVATE" in t[:40] else "pempub"
    if _PLACEHOLDER.match(t):
        return "placeholder"
    if re.fullmatch(r"AKIA[0-9A-Z]{16}", t):
        return "akia"
    if re.fullmatch(r"gh[pousr]_\w{20,}|(?:[a-z]{2,4}|key)[-_](?:live_|test_)?[A-Za-z0-9]{20,}|xox[abp]-[\w-]{10,}|AIza[\w-]{30,}|glpat-[\w-]{15,}", t):
        return "prefixed"
    if re.fullmatch(r"[0-9a-f]{8}-(?:[0-9a-f]{4}-){3}[0-9a-f]{12}", t, re.I):
        return "uuid"
    if re.fullmatch(r"[0-9a-f]{16,}", t) and not t.isdigit():
        return "hex"
    if re.fullmatch(r"eyJ[\w-]+\.[\w-]+\.?[\w-]*", t):
        return "jwt"
    if re.fullmatch(r"-?[\d.]+(?:px|vp|fp|%)?|0x[0-9a-fA-F]+", t):
        return "number"
    if re.fullmatch(r"#[0-9A-Fa-f]{3,8}", t):
        return "colour"
    if "/" in t and re.fullmatch(r"[\w.@$-]*(?:/[\w.@$-]+)+/?", t) and not (n >= 20 and (re.search(r"\d", t) and re.search(r"[A-Z]", t) or re.search(r"[a-z][A-Z]{2,}|[A-Z]{3,}[a-z]", t))):
        return "path"
    if _CAMEL.fullmatch(t):
        return "random" if n >= 10 and t.isalpha() and not t.islower() and not t.isupper() and re.search(r"[bcdfghjklmnpqrstvwxz]{5}", t.lower()) else "name"
    if _WORDPW.fullmatch(t) and n >= 7 and re.search(r"[A-Z@#&%!?*$+=]", t):
        return "wordpw"
    up, low, dig = any(c.isupper() for c in t), any(c.islower() for c in t), any(c.isdigit() for c in t)
    special = any(c in "@#$%&!?*+=^~/-_." for c in t)
    if t.isascii() and n >= 6:
        if re.fullmatch(r"[A-Za-z0-9+/_=-]+", t):
            if n >= 20 and up + low + dig >= 2:
                return "long"
            if up and low and (dig or not _CAMEL.fullmatch(t)):
                return "random" if n >= 10 else "piece"
        elif up + low + dig + special >= 3:
            return "strong"
    if re.fullmatch(r"[a-z]+(?:_[a-z]+)*_?\d*|[A-Za-z]+\d{0,2}", t):
        return "name"
    return "other"


def _name_class(t: str) -> str:
    words = [w.lower() for w in _SPLIT.findall(t)]
    if not words:
        return ""
    if words[0] == "input":
        return "conn"
    if any(w in PUBLIC_WORDS for w in words) and not (words[-1] in SECRET_WORDS or words[-1] == "key" and len(words) > 1 and words[-2] in KEY_BEFORE):
        return "public"
    if any(w in SECRET_WORDS for w in words) or t.lower() in SECRET_WORDS:
        return "secret"
    if any(w == "key" and (i == 0 and len(words) == 1 or i > 0 and words[i - 1] in KEY_BEFORE) for i, w in enumerate(words)) or any(a + b in SECRET_WORDS for a, b in zip(words, words[1:])):
        return "secret"
    if any(w == "id" for w in words):
        return "id"
    if any(w in CONN_WORDS for w in words):
        return "conn"
    return ""


def tokens(line: str) -> list[tuple[int, int, str, str]]:
    """(begin, end, text, place) of a region's tokens; place is code, literal or comment."""
    out: list[tuple[int, int, str, str]] = []
    quote, comment = "", line.lstrip().startswith("*")
    for m in _TOKEN.finditer(line):
        kind, a, t = m.lastgroup, m.start(), m[0]
        if kind == "quote":
            if not comment:
                if not quote:
                    quote = t
                elif quote == t:
                    quote = ""
            out.append((a, m.end(), t, "quote"))
            continue
        place = "comment" if comment else "literal" if quote else "code"
        if kind == "open":
            if not quote:
                comment = t != "*/"
            continue
        if kind == "url":
            c = _CRED_URL.match(t)
            if c:
                for g in range(1, 7):
                    if c[g]:
                        out.append((a + c.start(g), a + c.end(g), c[g], "urlpass" if g == 4 else "url"))
                continue
            base = t.partition("?")[0]
            out.append((a, a + len(base), base, "url"))
            for p in _PARAM.finditer(t):
                for g in (2, 3, 4):
                    out.append((a + p.start(g), a + p.end(g), p[g], "param"))
            continue
        if kind == "word" and place == "code":
            for w in _CODE_WORD.finditer(t):
                out.append((a + w.start(), a + w.end(), w[0], "code"))
            if t == "+":
                out.append((a, m.end(), t, "code"))
            continue
        out.append((a, m.end(), t, "data" if kind == "data" else place))
    return out


def features(toks: list[tuple[int, int, str, str]]) -> list[list[str]]:
    """Shape and context features of each token."""
    rows = []
    govern, direct, user, assigned = "", "", False, ""
    shapes = [("sign" if p == "quote" or not any(c.isalnum() for c in t) and len(t) < 4 else shape(t)) for _, _, t, p in toks]
    every = {_name_class(t) for _, _, t, p in toks if p != "quote"}
    wide = "secret" if "secret" in every else "conn" if "conn" in every else ""
    piece, nth, before = "", 0, ""
    for i, (_, _, t, place) in enumerate(toks):
        s, chained = shapes[i], ""
        nxt = next((x[2] for x in toks[i + 1 : i + 4] if x[3] != "quote"), "")
        if place == "literal" and i > 1:
            # pieces of a sum or list: what the piece before looked like
            if before in ("+", ",") and piece:
                chained = f"s={s}|chain={piece}"
        row = [f"s={s}", f"s={s}|g={govern}", f"s={s}|p={place}", f"p={place}|g={govern}", f"s={s}|d={direct}", f"s={s}|w={wide}", f"s={s}|g={govern}|p={place}"]
        if user:
            row.append(f"s={s}|user")
        if nxt in ("+", "join"):
            row.append(f"s={s}|next={nxt}")
        if assigned:
            row.append(f"s={s}|after={assigned}")
        if govern == "entry" and place == "literal":
            nth += 1
            row.append(f"s={s}|nth={min(nth, 3)}")
        if chained:
            row.append(f"{chained}|g={govern}")
        rows.append(row)
        if place != "quote":
            before = t
        if place == "literal":
            # a piece that looks like a name goes on as what the pieces before it were
            piece = piece if chained and s in ("name", "other", "short") else s
        elif place == "code" and s != "sign":
            piece = ""
        if s in ("name", "other", "placeholder", "piece", "short", "sign", "path") and place not in ("quote", "url", "urlpass"):
            c = "entry" if place == "code" and nxt == "(" and t.lower() in ENTRY_CALLS else _name_class(t)
            if c:
                govern, nth = c, 0
            low = t.lower()
            if low in ("bearer", "basic"):
                direct = low
            elif low in ("user", "username", "account"):
                user = True
            elif s == "sign" and t in ("===", "==", "!=="):
                assigned = "equals"
            elif c:
                direct = c if place != "code" else ""
        elif place == "data":
            govern = "public"
    return rows


@lru_cache(1)
def _model() -> Chain:
    return Chain.load(MODEL)


@lru_cache(1)
def _triggers() -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for word in TRIGGERS:
        automaton.add_word(word.replace("\x20", " "), 1)
    automaton.make_automaton()
    return automaton


def _regions(text: str) -> list[tuple[int, int]]:
    """The suspicious lines, each drawn out to the end of a key block that begins in it."""
    out: list[tuple[int, int]] = []
    done = -1
    low = text.lower()
    if len(low) != len(text):  # a few characters have longer lower forms
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    hits = {end for end, _ in _triggers().iter(low)}
    hits.update(m.start() for m in _LITERAL.finditer(text) if m[1] is None or _MIX.match(m[1]))
    hits = sorted(hits)
    for at in hits:
        if at < done:
            continue
        a = text.rfind("\n", 0, at) + 1
        b = text.find("\n", at)
        b = len(text) if b < 0 else b
        block = re.compile(_PEM, re.S).search(text, a, len(text)) if "-----BEGIN" in text[a:b] else None
        if block is not None and block.start() < b:
            b = text.find("\n", block.end())
            b = len(text) if b < 0 else b
        out.append((a, b))
        done = b
    return out


def find(text: str | None) -> list[list[tuple[int, int]]]:
    """The values of credentials in a text, each as the list of (begin, end) of its pieces.  Null and empty: none."""
    if not text:
        return []
    found: list[list[tuple[int, int]]] = []
    for a, b in _regions(text):
        toks = tokens(text[a:b])
        if not toks:
            continue
        current: list[tuple[int, int]] | None = None
        for (x, y, t, place), label in zip(toks, _model().viterbi(features(toks))):
            if label == "O" or place == "quote":
                continue
            if label == "B" or current is None:
                current = [(a + x, a + y)]
                found.append(current)
            else:
                current.append((a + x, a + y))
    return found


def lines(text: str | None) -> list[int]:
    """The numbers (from 1) of the lines on which a value begins, each once, in order."""
    return sorted({text.count("\n", 0, value[0][0]) + 1 for value in find(text)})


def redact(text: str | None, mask: str = "*") -> str | None:
    """The text with every character of a value but line breaks replaced; null stays null, the rest is untouched."""
    if not text:
        return text
    out, at = [], 0
    for a, b in sorted(piece for value in find(text) for piece in value):
        out += [text[at:a], re.sub(r"[^\r\n]", mask, text[a:b])]
        at = b
    return "".join([*out, text[at:]])


def examples(count: int = 2600, seed: int = 11) -> list[tuple[str, list[tuple[int, int]]]]:
    """Made-up lines with the spans of their values; about half have none."""
    rng = random.Random(seed)
    nouns = "order panel river window cloud ticket mirror garden engine violet basket harbor copper".split()
    alnum = string.ascii_letters + string.digits

    def word() -> str:
        return rng.choice(nouns)

    def camel() -> str:
        return word() + word().capitalize()

    def rand(n: int, more: str = "") -> str:
        while True:
            t = "".join(rng.choice(alnum + more) for _ in range(n))
            if re.search("[a-z]", t) and re.search("[A-Z]", t) and (n < 10 or re.search(r"\d", t)):
                return t

    def piece(n: int) -> str:
        """A piece of a value; many have letters alone and may look like names."""
        kind = rng.random()
        return (word() + word() + word()).capitalize()[:n] if kind < 0.3 else "".join(rng.choice(string.ascii_letters) for _ in range(n)) if kind < 0.45 else rand(n)

    def hexa(n: int) -> str:
        return "".join(rng.choice("0123456789abcdef") for _ in range(n))

    def pw() -> str:
        k = rng.random()
        if k < 0.45:
            return word().capitalize() + rng.choice("@#_-&") + str(rng.randrange(1000, 99999)) + rng.choice("!?*")
        if k < 0.75:
            t = rand(rng.randrange(10, 13))
            i = rng.randrange(2, 7)
            return t[:i] + rng.choice("@#$%&!") + t[i:]
        return rand(14)

    def pem(kind: str) -> str:
        return f"-----BEGIN {kind}-----\n" + "\n".join(rand(64, "+/") for _ in range(rng.randrange(1, 4))) + f"\n-----END {kind}-----"

    def prose() -> str:
        """A sentence in which words of secrets and logins are talked about."""
        pool = "the a your this please keep open after before stale list page user needs another look is empty seconds restore sync filter times destroyed together with note may be when it first later again".split()
        said = [rng.choice(pool) for _ in range(rng.randrange(4, 12))]
        said.insert(rng.randrange(len(said)), rng.choice(["login", "password", "token", "secret", "sign in", "login session", "authentication", "cookie", "密码", "key"]))
        more = rng.choice(["", "", f"{rng.choice('.?')} {' '.join(rng.choice(pool) for _ in range(3)).capitalize()}"])
        return rng.choice(["", "", "TODO ", "FIXME: "]) + " ".join(said).capitalize() + more + rng.choice(["", "", ".", "?", "!"])

    made = []
    for _ in range(count):
        q = rng.choice("'\"`") if rng.random() < 0.3 else "'"
        v, up, w = pw(), word().upper(), word()
        b64 = base64.b64encode(f"{w}:{pw()}".encode()).decode()
        tok = rng.choice([f"sk-{rand(32)}", f"key-{rand(32)}", f"ghp_{rand(36)}", f"qk_live_{rand(32)}", rand(32), rand(28)])
        four = [piece(8) for _ in range(4)]
        three = [piece(rng.choice([8, 12])) for _ in range(3)]
        four[0], three[0] = rand(8), rand(12)
        uuid = f"{hexa(8)}-{hexa(4)}-{hexa(4)}-{hexa(4)}-{hexa(12)}"
        secretname = rng.choice(["appSecret", "clientSecret", "aesKey", "hmacKey", "signKey", "accessToken", "apiKey", "token", "secretKey", "encryptionKey"])
        passname = rng.choice(["pwd", "password", "passwd", "dbPass", "loginPwd", "storePassword", "keyPass", "passphrase"])
        kind = rng.choice(["RSA PRIVATE KEY", "PRIVATE KEY", "EC PRIVATE KEY", "OPENSSH PRIVATE KEY"])
        good = [
            (f"const {up}_{rng.choice(['API_KEY', 'APP_SECRET', 'AUTH', 'SIGN_KEY', 'ACCESS_TOKEN', 'TOKEN'])} = {q}{tok}{q};", [tok]),
            (f"const {up}_{rng.choice(['API_KEY', 'APP_SECRET', 'AUTH', 'SIGN_KEY'])} = [{', '.join(f'{q}{x}{q}' for x in four)}].join('');", four),
            (f"const {secretname} = {' + '.join(f'{q}{x}{q}' for x in three)};", three),
            (f"final String {secretname} = \"{(t := rand(rng.choice([24, 32, 40]), '/+'))}\";", [t]),
            (f"let {passname} = {q}{v}{q};", [v]),
            (f"{camel()}.set{rng.choice(['Password', 'Pwd'])}({q}{v}{q});", [v]),
            (f"{camel()}.{rng.choice(['setApiKey', 'setSecret', 'withToken', 'authorize', 'signIn'])}({q}{(t := hexa(40))}{q});", [t]),
            (f"{camel()}.setHeader('Authorization', 'Basic {b64}');", [b64]),
            (f"headers['Authorization'] = 'Bearer {(t := 'eyJ' + rand(17) + '.eyJ' + rand(37) + '.' + rand(40))}';", [t]),
            (f"req.addHeader(\"X-Auth-Token\", \"{(t := hexa(40))}\");", [t]),
            (f"preferences.putSync('{rng.choice(['jwt', 'refreshToken', 'accessToken', 'sessionToken'])}', '{(t := rand(32, '+/'))}');", [t]),
            (f"{word()}.init({{ appId: '{rng.randrange(10**8, 10**9)}', appKey: '{(t := hexa(32))}' }});", [t]),
            (f"// {rng.choice(['密码', 'pwd', 'password', 'token', 'key', '口令', 'passwd'])}{rng.choice([': ', '=', ' = ', '：'])}{v}", [v]),
            (f"  /* {rng.choice(['密码', 'pwd', 'password', 'secret'])}: {v} */", [v]),
            (f"const conf = '{{\"user\":\"{w}\",\"{rng.choice(['password', 'secret', 'token'])}\":\"{v}\"}}';", [v]),
            (f"const {camel()} = '{rng.choice(['ftp', 'mysql', 'https', 'redis', 'mongodb'])}://{w}:{(t := rand(12))}@{word()}.example.org:{rng.randrange(1000, 9999)}/{word()}';", [t]),
            (f"const url = 'https://{w}.example.org/v1?{rng.choice(['access_token', 'api_key', 'token', 'secret', 'ak', 'sk'])}={(t := rand(28))}&page=3';", [t]),
            (f"conn = open(\"jdbc:mysql://{w}.example.org:3306/{word()}\", \"{word()}\", \"{v}\");", [v]),
            (f"const k = {'`' if q == chr(39) else q}{(t := pem(kind))}{'`' if q == chr(39) else q};", [t]),
            (f"this.{w}Cfg = {{ user: '{word()}', {rng.choice(['pass', 'secret', 'credential', 'passphrase', 'pwd'])}: '{v}' }};", [v]),
            (f"const accessKeyId = '{(t := 'AKIA' + ''.join(rng.choice(string.ascii_uppercase + string.digits) for _ in range(16)))}';", [t]),
            (f"const {rng.choice(['githubToken', 'ciToken', 'deployToken'])} = 'ghp_{(t := rand(36))}';".replace("ghp_" + t, (t2 := "ghp_" + t)), [t2]),
            (f"{rng.choice([camel() + '.', ''])}{rng.choice(['login', 'signIn', 'authenticate'])}('{word()}', '{(t := rng.choice([v, word() + str(rng.randrange(10, 9999)) + rng.choice('xyzk')]))}');", [t]),
            (f"const {rng.choice(['pwd', 'password', 'dbPass'])}{rng.choice(['', w.capitalize()])} = '{(t := word() + str(rng.randrange(10, 9999)) + rng.choice(['', '!', 'x']))}';", [t]),
            (f"if (input{w.capitalize()} === '{v}') {{ this.isAdmin = true; }}", [v]),
        ]
        bad = [
            f"const dsn{w.capitalize()} = 'mysql://localhost:3306/{word()}';",
            f"const {rng.choice(['token', 'apiKey', 'passKey', 'secret'])}{w.capitalize()} = '{rng.choice(['<token>', 'YOUR_API_KEY', 'xxxxxxxxxxxxxxxx', '', '********', 'changeme', '<your-secret>', 'REPLACE_ME', '${TOKEN}'])}';",
            f"let password{w.capitalize()}: string = '';",
            f"const pwdRule{w.capitalize()} = /^[A-Za-z0-9]{{8,16}}$/;",
            f"const tokenType{w.capitalize()} = 'Bearer';",
            f"const secret{w.capitalize()} = process.env.{up}_SECRET;",
            f"this.passwordHint{w.capitalize()} = $r('app.string.password_hint');",
            f"const sign{w.capitalize()} = this.keyStore.query{word().capitalize()}('{word()}');",
            f"const auth{w.capitalize()} = `Bearer ${{this.{camel()}}}`;",
            f"const commit{w.capitalize()} = '{hexa(40)}';",
            f"const checksum{w.capitalize()} = '{hexa(64)}';",
            f"const {rng.choice(['md5', 'sha1', 'digest', 'fileHash'])}{w.capitalize()} = '{hexa(rng.choice([32, 40]))}';",
            f"const requestId{w.capitalize()} = '{uuid}';",
            f"const icon{w.capitalize()} = 'data:image/png;base64,{rand(40, '+/')}';",
            f"const publicKey = '{pem('PUBLIC KEY')}';",
            f"const cert = `{pem('CERTIFICATE')}`;",
            f"{camel()}({{ {camel()}Key: 'pages/{word().capitalize()}{word().capitalize()}', {camel()}: {rng.randrange(9999)} }});",
            f"this.{camel()}Token = this.load{word().capitalize()}({camel()}, {rng.randrange(99)});",
            f"userAuth.{camel()}({{ {camel()}: '{word()}_{word()}_{rng.randrange(999)}' }});",
            f"promptAction.showToast({{ message: '{rng.choice(['Please enter your password', '请输入密码', 'The token has expired', '密码错误，请重试', 'Your password is too short'])}', duration: 2000 }});",
            f"// {rng.choice(['password must have 8 characters', 'token is read from the store', '密码长度至少8位', 'never log the secret', 'refresh the token every 30 minutes'])}",
            f"hilog.info(0x{hexa(4).upper()}, '{word().capitalize()}Model', 'token {word()} updated');",
            f"const {camel()} = preferences.getSync('{rng.choice(['token', 'password', 'secret'])}', '');",
            f"TextInput({{ placeholder: '{rng.choice(['password', 'Password', '密码'])}' }}).type(InputType.Password)",
            f"const url{w.capitalize()} = 'https://{w}.example.org/v1?{rng.choice(['page', 'id', 'sort', 'lang', 'v'])}={rand(rng.choice([10, 24]))}&size=3';",
            f"this.{camel()} = '{word()}.{word()}.{word()}{word().capitalize()}';",
            f"{camel()}.{word()}('{rng.choice([rand(8), rand(12), hexa(8), word() + str(rng.randrange(99)) + 'b', 'v' + str(rng.randrange(9)) + '.2b'])}', {rng.randrange(9)});",
            f"const {rng.choice(['names', 'items', 'parts'])}{w.capitalize()} = ['{rand(8)}', '{word()}', '{rand(8)}'].join('-');",
            f"this.{camel()}Label = '{word()}' + '{word()}{word().capitalize()}' + '{rand(8)}';",
            f"router.login('{word()}', this.{camel()});",
            f"const {rng.choice(['token', 'password', 'secret', 'pwd'])}{w.capitalize()} = '{rng.choice(['abc', 'xx', '', 'n/a', '***', 'none', 'todo'])}';",
            f"const tok{w.capitalize()} = await this.fetchToken('{word()}-{word()}');",
            f"// {prose()}",
            f"//{prose()}",
            f"//{prose()}",
            f"throw new Error(`{prose()} (${{this.{camel()}}})`);",
            f"{camel()}.{word()}({{ message: `{prose()} (${{this.{camel()}}})`, duration: {rng.randrange(9999)} }});",
            f"{camel()}('https://{w}.example.org/{word()}/{rng.randrange(999)}', `${{this.{camel()}}}/${{{word()}.{camel()}}}`);",
            f"const {camel()}Value = 'https://{w}.example.org/{word()}/{rng.randrange(999)}';  // {prose()}",
            f"{camel()}({{ {camel()}: 'https://{w}.example.org/{word()}', {word()}Key: {rng.randrange(9999)} }});  // {prose()}",
            f" * {prose()}",
            f"/* {prose()} */",
            f"Text('{prose()}')",
            f"hilog.info(0x{hexa(4).upper()}, '{word().capitalize()}', \"{prose()}\");",
            f"const pass = window.{camel()}.{word()}Password;",
            f"  cookie.name = '{word()}{word().capitalize()}{rng.randrange(9)}';",
        ]
        if rng.random() < 0.52:
            line, values = rng.choice(good)
        else:
            line, values = rng.choice(bad), []
        line = " " * rng.choice([0, 2, 4, 8]) + line
        spans, at = [], 0
        for value in values:
            a = line.index(value, at)
            spans.append((a, a + len(value)))
            at = a + len(value)
        made.append((line, spans))
    return made


def labelled(data: list[tuple[str, list[tuple[int, int]]]]) -> list[tuple[list[list[str]], list[str]]]:
    """Features and labels of made lines: pieces behind the first of a value are I."""
    out = []
    for line, spans in data:
        toks = tokens(line)
        tags, seen = [], False
        for a, b, _, place in toks:
            inside = place != "quote" and any(x < b and a < y for x, y in spans)
            tags.append("O" if not inside else "I" if seen else "B")
            seen = seen or inside
        out.append((features(toks), tags))
    return out


if __name__ == "__main__":
    train(labelled(examples()), ["O", "B", "I"]).save(MODEL)
