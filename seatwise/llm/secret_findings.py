"""Labelled findings to learn from: credentials, and what only looks like one.

Findings are made up from a parameter, each with the text before it, its path
and its label. Values are random, so nothing but their shape, their neighbours
and their path can be learnt.
"""

from __future__ import annotations

import random
import string

HEX = "0123456789abcdef"
ALNUM = string.ascii_letters + string.digits
URLSAFE = ALNUM + "-_"
BASE64 = ALNUM + "+/"
#: Names that stand before credentials, and before other long values.
SECRET_NAMES = (
    "token secret password passwd pwd api_key apikey access_key secret_key auth_token bearer "
    "credential private_key client_secret authorization key passphrase access_token"
).split()
OTHER_NAMES = (
    "sha commit hash md5 sha1 sha256 checksum digest uuid guid etag integrity revision version "
    "build nonce request_id trace_id session color file image blob object index module package "
    "class function url path link"
).split()
WORDS = (
    "user name config manager service handler default value string number request response "
    "context factory builder parser reader writer client server session controller provider "
    "adapter listener account address message content document element internal external process "
    "application environment production development example sample placeholder changeme insert "
    "your here test dummy fake secret password token public private international configuration"
).split()
PATHS = ["src/app.py", "config/settings.yml", ".env", "deploy/prod.tf", "main.go", "web", "crawl"]
CALM_PATHS = ["tests/fixtures/data.json", "docs/example.md", "package-lock.json", "vendor/lib.js"]
#: Beginnings of issued keys and the length of the rest.
ISSUED = [("AKIA", string.ascii_uppercase + string.digits, 16), ("ghp_", ALNUM, 36)]
ISSUED += [("sk-", ALNUM, 40), ("xoxb-", ALNUM + "-", 40), ("AIza", URLSAFE, 35)]
ISSUED += [("glpat-", URLSAFE, 20), ("npm_", ALNUM, 36), ("sk_live_", ALNUM, 24)]

Finding = tuple[str, str, str, str, int]


class FindingMaker:
    def __init__(self, seed: int):
        self.random = random.Random(seed)

    def some(self, letters: str, low: int, high: int) -> str:
        return "".join(self.random.choices(letters, k=self.random.randint(low, high)))

    def prose(self) -> str:
        return " ".join(self.some(string.ascii_lowercase, 1, 9) for _ in range(6)) + " "

    def named(self, name: str) -> tuple[str, str]:
        name = self.random.choice([name, name.upper(), f"{self.some('abcdest', 2, 5)}_{name}"])
        sign = self.random.choice([" = ", "=", ": ", " := ", "$$$ =*** ", "=> "])
        quote = self.random.choice(['"', '"', "'", ""])
        lead = self.prose() if self.random.random() < 0.7 else ""
        return f"{lead}{name}{sign}{quote}", quote

    def secret(self) -> Finding:
        kind = self.random.random()
        path = self.random.choice(PATHS)
        if kind < 0.2:
            start, letters, size = self.random.choice(ISSUED)
            before = self.random.choice([self.prose(), self.named("key")[0]])
            return before, start + self.some(letters, size, size), self.prose(), path, 1
        before, quote = self.named(self.random.choice(SECRET_NAMES))
        if kind < 0.55:
            value = self.some(HEX, 32, 64)
            value = value.upper() if self.random.random() < 0.3 else value
        elif kind < 0.85:
            value = self.some(self.random.choice([ALNUM, URLSAFE, BASE64]), 20, 64)
        else:
            value = self.some(ALNUM + "!@#%^&*", 10, 18) + self.random.choice("0123456789!#")
        return before, value, quote + self.random.choice(["", "###", "!!"]) + " ", path, 1

    def other(self) -> Finding:
        kind = self.random.random()
        path = self.random.choice(PATHS + CALM_PATHS)
        before, quote = self.named(self.random.choice(OTHER_NAMES))
        if kind < 0.2:
            value = self.some(HEX, 32, 64)
        elif kind < 0.3:
            parts = [self.some(HEX, n, n) for n in (8, 4, 4, 4, 12)]
            value = "-".join(parts)
            if self.random.random() < 0.5:
                before = self.prose()
        elif kind < 0.55:
            words = self.random.sample(WORDS, self.random.randint(2, 5))
            joiner = self.random.choice(["_", "-", ".", "/", ""])
            value = joiner.join(words) if joiner else "".join(map(str.title, words))
            value += self.random.choice(["", "", "2", "_v1", "01"])
            before = self.random.choice([before, self.prose(), self.named("token")[0]])
        elif kind < 0.7:
            mark = self.random.choice(["xxxxxxxx", "your_", "<insert", "changeme", "example", "****"])
            value = mark + self.some("x*", 8, 20) + self.random.choice(["", "_here", "123"])
            before, quote = self.named(self.random.choice(SECRET_NAMES))
        elif kind < 0.8:
            value = self.some(string.digits, 12, 24)
            before = self.random.choice([before, self.prose()])
        elif kind < 0.9:
            value = self.some(ALNUM, 20, 60)
            path = self.random.choice(CALM_PATHS)
        else:
            syllables = ["th", "er", "on", "in", "an", "re", "ed", "ti", "ou", "ea", "ing", "ble"]
            value = "".join(self.random.choices(syllables, k=self.random.randint(8, 14)))
            value = value.capitalize() if self.random.random() < 0.5 else value + "2"
            before = self.prose()
        return before, value, quote + " ", path, 0

    def block(self, label: int) -> Finding:
        """A key between its markers, or what stands there in place of one."""
        kind = self.random.choice(["", "RSA ", "EC ", "OPENSSH ", "ENCRYPTED "]) + "PRIVATE KEY-----"
        if label:
            full = self.random.choice([0, 0, self.random.randint(1, 26)])
            lines = [self.some(BASE64, 64, 64) for _ in range(full)]
            lines.append(self.some(BASE64, 3, 64 if full else 24) + self.random.choice(["", "=", "=="]))
        else:
            mark = ["xxxxxxxx", "yourkeyhere", "INSERTKEYHERE", "examplekey", "placeholder"]
            lines = [self.random.choice(mark)] * self.random.randint(1, 4)
        ends = [f"-----END {kind}"] if not label or self.random.random() < 0.8 else []
        value = self.random.choice(["\n", "\n", "\\n"]).join([f"-----BEGIN {kind}", *lines, *ends])
        before = self.random.choice([self.prose(), self.named("private_key")[0], ""])
        return before, value, "\n", self.random.choice(PATHS + CALM_PATHS), label

    def login(self) -> str:
        scheme = self.random.choice(["postgres", "mysql", "https", "redis", "amqp"])
        lead = self.random.choice([self.prose(), "", self.named("url")[0], self.named("link")[0]])
        return f"{lead}{scheme}://{self.some('abcdest', 0, 7)}:"

    def assigned(self, label: int) -> Finding:
        """A short value after a secret name or in an address, or what is none there."""
        path = self.random.choice(PATHS)
        name = self.random.choice(SECRET_NAMES)
        name = self.random.choice([name, name.upper(), f"{self.some('abcdest', 2, 5)}_{name}"])
        sign = self.random.choice(["=", ": ", " = ", ":", "="])
        before = self.random.choice([self.prose(), "", "\n"]) + name + sign
        if label:
            signs = self.random.choice(["!@#%^&*", "!@#$%&*-_.+?", "!#", ""])
            value = self.some(ALNUM + signs, 7, 18) + self.random.choice("0123456789")
            word = self.random.choice([*WORDS, self.some(string.ascii_lowercase, 4, 8)])
            if self.random.random() < 0.4:
                value = word + self.some(string.digits + signs, 2, 5) + self.some(ALNUM + signs, 1, 4)
            if self.random.random() < 0.5:
                return self.login(), value, f"@{self.some('abcdest', 2, 8)}/x ", path, 1
            return before, value, self.random.choice([" ", "\n", ""]), path, 1
        words = self.random.sample(WORDS, 2)
        value = self.random.choice(
            [
                words[0] + self.random.choice(["", "", ".", ",", ")"]),
                self.some(string.ascii_lowercase, 4, 14) + self.random.choice(["", "", ".", ","]),
                self.random.choice(["None", "null", "true", "false", "required", "string", "Optional"]),
                f"get_{words[0]}()",
                f"{words[0]}.{words[1]}" + self.random.choice(["", "()", "[0]"]),
                "${" + "_".join(words).upper() + "}",
                "$" + "_".join(words[: self.random.randint(1, 2)]).upper(),
                f"<{words[0]}>",
                self.some("x*", 5, 12),
                self.random.choice(["your_", "example_", "changeme", "placeholder"]) + words[0],
            ]
        )
        if self.random.random() < 0.1:
            value = self.random.choice(["password", "pass", "${" + words[0].upper() + "}", "xxxx"])
            return self.login(), value, f"@{self.some('abcdest', 2, 8)}/x ", path, 0
        return before, value, self.random.choice([" ", "\n"]), path, 0


def labelled_findings(count: int, seed: int = 3) -> list[Finding]:
    """``(before, value, after, path, label)``, half of them credentials."""
    maker = FindingMaker(seed)
    return [
        maker.block(i % 2)
        if i % 16 >= 14
        else maker.assigned(i % 2)
        if i % 16 >= 10
        else maker.secret()
        if i % 2
        else maker.other()
        for i in range(count)
    ]
