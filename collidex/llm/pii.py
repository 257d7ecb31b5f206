"""Operator 6: personal data replaced by keyed surrogates.

Emails, addresses of hosts, phone, card, account and social security numbers, secrets
and titled names are found in whole texts and replaced by others of the same type,
format, script and, for names, gender. A surrogate depends on a key and on the entity's
canonical form alone, so all mentions of an entity, however written, get the same one
in every document. Parts of names are entities of their own: given names, by gender,
and family names; so "Mr Smith" agrees with "Mr John Smith", and both with "John Smith"
and "Smith" without a title in a text that names the person with one. A title without a
gender takes that of the same given name in the text, or one guessed by the name. Distinctness is checked over the corpus: entities that share a
surrogate, or whose surrogate is itself an entity of the corpus, get their next one,
until none is left.

Only found entities are shuffled. Texts meet the few renewed surrogates by document id.
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import re

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from collidex.llm.common import only_ids, saved, table, without_ids

# fixed values: titles by gender, and given names and family names to choose from, by script
TITLES = {"Mr": "m", "Herr": "m", "Monsieur": "m", "Señor": "m", "Sr": "m", "Sir": "m", "господин": "m",
          "Mrs": "f", "Ms": "f", "Miss": "f", "Frau": "f", "Madame": "f", "Mme": "f", "Señora": "f", "Sra": "f", "Lady": "f", "госпожа": "f",
          "Mister": "m", "Lord": "m", "г-н": "m", "Mlle": "f", "Dame": "f", "г-жа": "f",
          "Dr": "n", "Prof": "n", "Professor": "n", "Doctor": "n", "Doktor": "n", "Rev": "n", "Mx": "n", "доктор": "n", "профессор": "n"}
GIVEN = {("latin", "m"): "Adam Bruno Carl David Edgar Felix George Hugo Ivan Jonas Karl Leon Martin Noel Oscar Paul Robert Simon Thomas Victor".split(),
         ("latin", "f"): "Alice Berta Clara Diana Emma Flora Greta Helen Irene Julia Karin Laura Maria Nora Olga Paula Rosa Sofia Teresa Vera".split(),
         ("cyrillic", "m"): "Алексей Борис Виктор Григорий Дмитрий Егор Иван Кирилл Леонид Максим Николай Олег Павел Роман Сергей".split(),
         ("cyrillic", "f"): "Анна Вера Галина Дарья Елена Зоя Ирина Клара Лидия Мария Нина Ольга Полина Раиса Софья".split()}
SYLLABLES = {"latin": "an bel cor dan el far gar hol in jan kel lor mar nor or per ral san tor ul van wel zan".split(),
             "cyrillic": "ан бел вор гор дан ел жар зин ив кор лан мир нов ор пет рой сан тур ул фед".split()}

_TITLE = rf"(?:{'|'.join(sorted(TITLES, key=len, reverse=True))})"
_NAME = rf"(?!{_TITLE}\b)(?:[A-ZÀ-ÖØ-ÞА-ЯЁ][\w'’-]*[a-zß-öø-ÿа-яё]|[A-ZÀ-ÖØ-ÞА-ЯЁ][A-ZÀ-ÖØ-ÞА-ЯЁ'’-]{{1,30}}(?!\w))"
_INITIAL = r"(?:[A-ZÀ-ÖØ-ÞА-ЯЁ]\.-?)+"
_PARTICLE = r"(?:van|von|de|der|den|del|della|di|da|dos|du|la|le|ten|ter|zu|bin|ibn|al|el|y)"
_GAP = r"[ \t\u00a0]{1,2}"
_REST = rf"(?:(?:{_INITIAL}|{_PARTICLE}){_GAP}|{_INITIAL}(?={_NAME}))*{_NAME}"
_HEX4 = r"[0-9A-Fa-f]{1,4}"
PATTERN = re.compile("|".join([
    r"(?P<email>[A-Za-z0-9][\w.%+-]{0,63}+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,})",
    r"(?P<key>\bAKIA[0-9A-Z]{16}\b|\bgh[pousr]_[A-Za-z0-9]{36}\b|\bsk-[A-Za-z0-9_-]{20,}|\beyJ[\w-]{10,}\.[\w-]{10,}\.[\w-]{5,})",
    r"(?P<secret>(?i:\b(?:password|passwd|pwd|secret|token|api_?key)\b[\"']?\s*[=:]\s*[\"']?)(?P<value>[^\s\"',;]{4,}))",
    r"(?P<iban>\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b)",
    r"(?P<ip>(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\w]|\.\d))",
    rf"(?P<ip6>(?<![\w:])(?:(?:{_HEX4}:){{7}}{_HEX4}|(?:{_HEX4}(?::{_HEX4}){{0,6}})?::(?:{_HEX4}(?::{_HEX4}){{0,6}})?)(?![\w:]))",
    r"(?P<card>(?<![\w-])(?:\d{13,19}|\d{4}(?P<sep>[ -])\d{4}(?P=sep)\d{4}(?P=sep)\d{1,7}|\d{4}[ -]\d{6}[ -]\d{5})(?![\w-]))",
    r"(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))",
    r"(?P<phone>(?<![\w.+])(?:\+[1-9]\d{7,14}|(?:\+\d{1,3}[ .-]?|(?<!\d[.-])(?:1[ .-])?)(?:\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}|\d{3}[ .-]\d{3}[ .-]\d{4}(?![.-]\d))"
    r"|\+\d{1,3}[ .-]?(?:\d{1,2}(?:[ .-]\d{2}){4}|\d{2,4}(?:[ .-]?\d{2,4}){2,3})|(?<!\d[.-])0\d{2,4}[ /-]\d{5,8}(?![.-]\d))(?!\w))",
    r"(?P<hex>\b(?=[0-9a-f]*[a-f])(?=[0-9a-f]*[0-9])(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64})\b)",
    rf"(?P<name>\b(?P<titles>(?:{_TITLE}\.?(?:{_GAP}|\n))+){_REST}(?:{_GAP}{_REST})*)",
]))

KINDS = [k for k in PATTERN.groupindex if k not in ("value", "sep", "titles")]
#: Signs without which no word begins an entity: in the word itself, or after it and white space for ``=`` and ``:``.
SIGNS = re.compile(r"[@:=\d]")
HEADS = [re.compile(r"AKIA|gh[pousr]_|sk-|eyJ"), re.compile(rf"(?:{'|'.join(TITLES)})(?!\w)")]
SPACE = re.compile(r"\s")
#: Calling codes, by separator or by the numbering plan.
COUNTRY = re.compile(r"\A\+(?:\d{1,3}(?:[ .-]|(?=\())|[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})(?=[(\d])")
#: Most rounds in which clashing surrogates are renewed; the forms grow with the round.
ROUNDS = 200


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def _canonical(kind: str, text: str) -> str | None:
    """The form by which mentions of one entity agree; None for what only looks like one."""
    if kind == "email":
        return text.lower()
    if kind == "card":
        digits = re.sub(r"\D", "", text)
        return digits if (luhn(digits) or len(digits) == 16) and len(set(digits)) > 1 else None
    if kind in ("phone", "ssn"):
        return re.sub(r"\D", "", COUNTRY.sub("", text))
    if kind == "iban":
        return text.replace(" ", "")
    if kind == "ip6":
        try:
            return ipaddress.IPv6Address(text).exploded if re.search(r"\d", text) and text != "::1" else None
        except ValueError:
            return None
    return text


def _matches(text: str):
    """The matches of ``PATTERN.finditer``, tried only in words in which one can begin (most words of prose hold none)."""
    done = 0
    for at in sorted(m.start() for p in (SIGNS, *HEADS) for m in p.finditer(text)):
        if at < done:
            continue
        start = at
        while start > done and text[at] in "=:" and text[start - 1].isspace():
            start -= 1
        while start > done and not text[start - 1].isspace():
            start -= 1
        space = SPACE.search(text, at)
        end = space.start() if space else len(text)
        while start < end:
            m = PATTERN.match(text, start)
            if m:
                yield m
            start = m.end() if m else start + 1
        done = start


def _plain(word: str) -> str:
    return word.title() if len(word) > 1 and word.isupper() else word


def _guess(given: str) -> str:
    for gender in "mf":
        if any(given in names for (_, g), names in GIVEN.items() if g == gender):
            return gender
    return "f" if given[-1] in "aа" else "m"


def _tagged(words: list[str], gender: str) -> list[str]:
    """Words of a name: ``i`` initials, ``p`` particles, ``f`` the family name, ``g`` and the gender given names."""
    out = ["i" + w if re.fullmatch(_INITIAL, w) else "p" + w if re.fullmatch(_PARTICLE, w) else "g" + gender + _plain(w) for w in words]
    return [*out[:-1], "f" + _plain(words[-1])]


def _names(text: str, named: list[tuple[int, int, str]], found: list[tuple]) -> list[tuple]:
    """Mentions of the persons that a text names with a title, those without one included."""
    split = [re.findall(r"[^\s.]\.(?=[^\s.-]{2})|\S+", text[i:j]) for i, j, _ in named]
    genders, families = {}, {_plain(w[-1]) for w in split if len(w) > 1}
    for words, (_, _, gender) in zip(split, named):
        for w in words[:-1]:
            if gender != "n":
                genders[_plain(w)] = gender
    known, out = {}, []
    for words, (_, _, gender) in zip(split, named):
        for w in words[:-1]:
            if not re.fullmatch(f"{_INITIAL}|{_PARTICLE}", w):
                known.setdefault(_plain(w), "g" + (gender if gender != "n" else genders.get(_plain(w)) or _guess(_plain(w))) + _plain(w))
    known.update((f, "f" + f) for f in sorted(families))
    for words, (i, j, gender) in zip(split, named):
        tags = _tagged(words, gender)
        tags = [known.get(t[2:], t) if t[0] == "g" and gender == "n" else t for t in tags]
        if len(words) == 1:
            tags = [known.setdefault(_plain(words[0]), tags[0])]
        out.append((i, j, "name", "\x1e".join(tags)))
    known = {w: tag for w, tag in known.items() if w not in TITLES}
    if not known:
        return out
    any_of = "|".join(re.escape(w) for k in sorted(known, key=len, reverse=True) for w in dict.fromkeys((k, k.upper())))
    one = rf"(?:{any_of})(?![\w@])"
    bare = re.compile(rf"(?<![\w@]){one}(?:{_GAP}(?:{_INITIAL}{_GAP})*{one})*")
    at = 0
    for start, end in [*sorted((x[0], x[1]) for x in [*found, *out]), (len(text), len(text))]:
        for m in bare.finditer(text, at, start):
            words = m[0].split()
            out.append((m.start(), m.end(), "name", "\x1e".join(known.get(_plain(w)) or known.get(w) or "i" + w for w in words)))
        at = end
    return out


def mentions(text: str | None):
    """(start, end, kind, canonical form) of each entity, in order, without overlaps."""
    found, named = [], []
    for m in _matches(text or ""):
        kind, at = next(k for k in KINDS if m[k] is not None), m.span()
        if kind == "name":
            genders = [TITLES[x] for x in re.findall(_TITLE, m["titles"])]
            end = m.end() - 2 if m[0].endswith(("'s", "’s")) else m.end()
            named.append((m.end("titles"), end, next((g for g in genders if g != "n"), "n")))       # the title stays
            continue
        if kind == "secret":
            at = m.span("value")
        canonical = _canonical(kind, text[slice(*at)])
        if canonical is not None:
            found.append((*at, kind, canonical))
    return sorted(found + _names(text, named, found)) if named else found


def entities_of(kind: str, canonical: str) -> list[tuple[str, str]]:
    """What gets a surrogate of its own: the mention, or the given and family names in it."""
    if kind != "name":
        return [(kind, canonical)]
    return [("given" if x[0] == "g" else "family", x[1:]) for x in canonical.split("\x1e") if x[0] in "gf"]


class _Stream:
    """Numbers drawn by key, kind, entity and attempt."""

    def __init__(self, key: bytes, *parts):
        self.seed, self.n = hmac.new(key, "\x1f".join(map(str, parts)).encode("utf-8", "surrogatepass"), hashlib.sha256).digest(), 0
        self.pool = int.from_bytes(self.seed + hashlib.sha256(self.seed).digest(), "big")

    def below(self, n: int) -> int:
        if self.pool < 1 << 64:
            self.seed = hashlib.sha256(self.seed + b"+").digest()
            self.pool = int.from_bytes(self.seed + hashlib.sha256(self.seed).digest(), "big")
        self.pool, x = divmod(self.pool, n)
        return x


def _alike(text: str, s: _Stream) -> str:
    """Letters for letters of the same case, digits for digits; all else stays."""
    out = []
    for c in text:
        if c.isdigit():
            out.append(str(s.below(10)))
        elif c.isalpha():
            d = "abcdefghijklmnopqrstuvwxyz"[s.below(26)]
            out.append(d.upper() if c.isupper() else d)
        else:
            out.append(c)
    return "".join(out)


def surrogate(kind: str, canonical: str, attempt: int, key: bytes) -> str:
    """The replacement's canonical form."""
    s = _Stream(key, kind, canonical, attempt)
    if kind == "email":
        local, domain = canonical.split("@")
        labels = domain.split(".")
        d = _Stream(key, "domain", domain)      # mentions of one domain stay together
        return _alike(local + "a" * (attempt // 4), s) + "@" + ".".join([_alike(x, d) for x in labels[:-1]] + labels[-1:])
    if kind == "ip":
        if attempt > 3:                          # forms of few digits run out
            return ".".join(str(1 + s.below(254)) for _ in range(4))
        low = {1: (1, 9), 2: (10, 90), 3: (100, 155)}
        return ".".join(str(low[len(x)][0] + s.below(low[len(x)][1])) for x in canonical.split("."))
    if kind == "ip6":
        groups = [x if attempt > 3 else x.lstrip("0") for x in canonical.split(":")]
        return ":".join(f"{s.below(15 * 16 ** (len(x) - 1)) + 16 ** (len(x) - 1) if x else 0:04x}" for x in groups)
    if kind == "hex":
        return "".join("0123456789abcdef"[s.below(16)] for _ in canonical)
    if kind == "key":
        head = next((h for h in ("AKIA", "ghp_", "gho_", "ghu_", "ghs_", "ghr_", "sk-", "eyJ") if canonical.startswith(h)), "")
        return head + _alike(canonical[len(head):], s)
    if kind == "card":
        body = canonical[0] + "".join(str(s.below(10)) for _ in canonical[1:-1])
        return next(body + d for d in "0123456789" if luhn(body + d)) if luhn(canonical) else _alike(canonical, s)
    if kind in ("phone", "ssn"):
        return "".join(c if c == "0" and i == 0 else str(1 + s.below(9)) if i < 4 else str(s.below(10)) for i, c in enumerate(canonical))
    if kind == "iban":
        body = _alike(canonical[4:], s)
        rest = int("".join(str(int(c, 36)) for c in body + canonical[:2] + "00")) % 97
        return f"{canonical[:2]}{98 - rest:02d}{body}"
    if kind in ("given", "family"):
        script = "cyrillic" if re.search("[Ѐ-ӿ]", canonical) else "latin"
        syllables, gender = SYLLABLES[script], canonical[0]
        if kind == "given" and attempt < 2:
            return gender + GIVEN[script, gender][s.below(len(GIVEN[script, gender]))]
        new = "".join(syllables[s.below(len(syllables))] for _ in range((3 if kind == "family" else 2) + attempt // 2)).capitalize()
        return new if kind == "family" else gender + new + ("" if gender == "m" else "a" if script == "latin" else "а")
    if kind == "secret":
        return _alike(canonical + "a" * (attempt // 4), s)
    return _alike(canonical, s)


def written(kind: str, mention: str, new: str) -> str:
    """A surrogate in the format of a mention: its separators, spacing and case."""
    if kind in ("card", "phone", "ssn"):
        head = (COUNTRY.match(mention) or [""])[0]      # the country code stays
        digits = iter(new)
        return head + re.sub(r"\d", lambda _: next(digits), mention[len(head):])
    if kind == "iban":
        signs = iter(new)
        return re.sub(r"\S", lambda _: next(signs), mention)
    if kind == "email" and len(mention) != len(new):
        return new.upper() if mention.isupper() else new
    if kind == "email":
        return "".join(n.upper() if m.isupper() else n for m, n in zip(mention, new))
    if kind == "ip6":
        groups = new.split(":")
        head, short, tail = mention.partition("::")
        head, tail = (x.split(":") if x else [] for x in (head, tail))
        inner = groups[len(head):8 - len(tail)]
        if any(int(x, 16) for x in inner):
            out = ":".join(groups)
        else:
            pad = [f"{int(x, 16):0{len(m)}x}" for m, x in zip(head + tail, groups[:len(head)] + groups[8 - len(tail):])]
            out = ":".join(pad[:len(head)]) + short + ":".join(pad[len(head):])
        return out.upper() if mention.upper() == mention else out
    return new
    return new


def _renamed(mention: str, canonical: str, new: list[str], key: bytes) -> str:
    """A name in the format of a mention; initials are shifted, particles stay."""
    shift, tags, new = 1 + _Stream(key, "initial").below(25), iter(canonical.split("\x1e")), iter(new)

    def word(m) -> str:
        tag = next(tags)
        if tag[0] == "p":
            return m[0]
        if tag[0] == "i":
            return re.sub(r"\w", lambda c: chr(65 + (ord(c[0]) - 65 + shift) % 26) if c[0].isascii() else "N", m[0])
        x = next(new)[tag[0] == "g":]
        return x.upper() if len(m[0]) > 1 and m[0].isupper() else x

    return re.sub(r"[^\s.]\.(?=[^\s.-]{2})|\S+", word, mention)


def replaced(text: str, key: bytes, renewed: dict) -> tuple[str, int]:
    out, at, n = [], 0, 0
    for start, end, kind, canonical in mentions(text):
        new = [surrogate(k, c, renewed.get(f"{k}\x1f{c}", 0), key) for k, c in entities_of(kind, canonical)]
        out += [text[at:start], _renamed(text[start:end], canonical, new, key) if kind == "name" else written(kind, text[start:end], new[0])]
        at, n = end, n + 1
    return "".join([*out, text[at:]]), n


def pii_surrogates(docs: DataFrame, key: bytes = b"surrogates", rounds: int = ROUNDS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, text, n_entities``, the text with surrogates.

    A null text stays null with no entities. Whole texts are read. Rows of null id and rows
    that repeat an id are replaced like all others; other columns are not read; an empty
    table gives an empty result. Texts without entities come through unchanged. Clashes
    are renewed in forms that grow with the round; if some are left after ``rounds`` rounds,
    as where a fixed format (phone, social security number) has fewer forms than the corpus
    has entities, it fails.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))

    def find(batches):
        for b in batches:
            rows = {(i, kind, c) for i, t in zip(b["doc_id"], b["text"]) if isinstance(t, str) for _, _, k, whole in mentions(t) for kind, c in entities_of(k, whole)}
            pdf = pd.DataFrame(sorted(rows, key=str), columns=["doc_id", "kind", "canonical"])
            pdf["doc_id"] = pdf["doc_id"].astype("Int64")
            yield pdf

    found = saved(docs.select(F.coalesce("doc_id", F.lit(-1)).alias("doc_id"), "text").mapInPandas(find, "doc_id long, kind string, canonical string"), "mentions")
    entities = saved(found.select("kind", "canonical").distinct(), "entities")

    @F.pandas_udf("string")
    def new(kind: pd.Series, canonical: pd.Series, attempt: pd.Series) -> pd.Series:
        return pd.Series([surrogate(k, c, a, key) for k, c, a in zip(kind, canonical, attempt)], dtype=object)

    chosen = saved(entities.withColumn("attempt", F.lit(0)).withColumn("new", new("kind", "canonical", "attempt")), "chosen")
    for left in range(rounds, -1, -1):
        first = chosen.groupBy("kind", "new").agg(F.min("canonical").alias("first"))
        taken = entities.select("kind", F.col("canonical").alias("new"), F.lit(True).alias("taken"))
        checked = saved(chosen.join(first, ["kind", "new"]).join(taken, ["kind", "new"], "left").select(
            "kind", "canonical", "new", "attempt", (F.coalesce("taken", F.lit(False)) | (F.col("canonical") != F.col("first"))).alias("clash")), "checked")
        if checked.filter("clash").isEmpty():
            break
        if not left:
            few = sorted(r.kind for r in checked.filter("clash").select("kind").distinct().collect())
            raise ValueError(f"after {rounds} rounds, different entities still share surrogates or these are entities: {', '.join(few)}")
        retry = checked.filter("clash").select("kind", "canonical", (F.col("attempt") + 1).alias("attempt"))
        chosen = saved(checked.filter("NOT clash").select("kind", "canonical", "attempt", "new").unionByName(
            retry.withColumn("new", new("kind", "canonical", "attempt"))), "chosen")
    renewed = chosen.filter("attempt > 0").select("kind", "canonical", "attempt")
    maps = saved(found.join(renewed, ["kind", "canonical"]).groupBy("doc_id").agg(F.map_from_entries(
        F.collect_set(F.struct(F.concat_ws("\x1f", "kind", "canonical"), F.col("attempt")))).alias("renewed")), "renewed")

    @F.pandas_udf("text string, n_entities long")
    def rewrite(text: pd.Series, renewed: pd.Series) -> pd.DataFrame:
        rows = [(None, 0) if t is None else replaced(t, key, dict(r) if r is not None else {}) for t, r in zip(text, renewed)]
        return pd.DataFrame(rows, columns=["text", "n_entities"])

    kept = docs.withColumn("at", F.coalesce("doc_id", F.lit(-1)))
    ids = maps.select(F.col("doc_id").alias("at"))
    plain = without_ids(kept, ids, "at").withColumn("renewed", F.lit(None).cast("map<string,int>"))
    some = only_ids(kept, ids, "at").join(maps.withColumnRenamed("doc_id", "at"), "at").select("at", "doc_id", "text", "renewed")
    both = plain.select("at", "doc_id", "text", "renewed").unionByName(some)
    return both.select("doc_id", rewrite("text", "renewed").alias("r")).select("doc_id", "r.text", "r.n_entities")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_surrogates(table(spark, sf_dir, "documents"))
