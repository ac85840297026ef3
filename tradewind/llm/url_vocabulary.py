"""URL filtering by host and path rules and a weighted vocabulary.

Rules first: a rule fits its host and all subdomains when the url's path starts
with the rule's path; of several the longest wins. An url without a rule is
judged by the vocabulary: an Aho-Corasick automaton finds its terms in one pass
over host and path; a hit counts only when neither neighbour is a letter or digit
(boundary check). One strict term, or ``soft_limit`` distinct soft terms, block; the inflected
forms of a soft term are one term.

The automaton and the rules are parameters of bounded size and go to the tasks
with the function; rows are judged where they lie, without a shuffle.

Defined results: a null url, or one without ``://``, has an empty host and path,
fits no rule and is allowed; an empty table gives no rows; repeated rows are
judged each; a null id stays null; extra columns are ignored; of rules of equal length
the later in the alphabet wins; a very long url is searched whole, once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.tables import UPPER, ascii_lower

# Fixed values of the contract, as host and path.
CONTRACT_RULES = {
    "net/": "block",
    "example.net/en/": "allow",
    "example.com/de/": "block",
    "org/fr/": "allow",
}


@dataclass(frozen=True)
class Vocabulary:
    """Terms in lower case. One ``strict`` hit or ``soft_limit`` distinct ``soft`` hits block.

    ``forms`` are pairs of a soft term and the name that all its forms share, so that
    "bet" and "bets" are one hit; a term without a pair has its own name.
    """

    strict: tuple[str, ...]
    soft: tuple[str, ...]
    soft_limit: int = 2
    forms: tuple[tuple[str, str], ...] = ()

    def terms_by_name(self) -> dict[str, list[str]]:
        """Soft terms of every name."""
        names, terms = dict(self.forms), {}
        for term in self.soft:
            terms.setdefault(names.get(term, term), []).append(term)
        return terms


# Terms that hardly stand in an ordinary url.
_STRICT = """
spam-farm ads-track link-farm linkfarm doorway-page clickbait clickfraud
porn porno pornos pornography pornographic pornstar pornstars xxx xrated x-rated hentai milf milfs camgirl camgirls
camsex sexcam sexcams sexchat sextape sextapes sexshop sexshops hardcore-sex nsfw nudes blowjob blowjobs handjob
handjobs cumshot cumshots creampie gangbang gangbangs bukkake threesome threesomes upskirt upskirts voyeurism dildo
dildos vibrators fetishes bdsm erotica escort-service escort-services call-girls callgirl callgirls hookups
adult-chat adult-content adult-dating adult-entertainment adult-film adult-films adult-movie adult-movies
adult-site adult-sites adult-toys adult-video adult-videos adultchat adultdating adultvideo adultvideos
casino casinos online-casino sportsbook sportsbooks bookmaker bookmakers bookie bookies
slot-machine slot-machines slotmachine slotmachines free-spins freespins betting-tips bettingtips no-deposit
jackpots gambling gamblers online-poker video-poker
viagra cialis levitra sildenafil tadalafil vardenafil kamagra xanax valium ambien tramadol oxycontin oxycodone
hydrocodone vicodin percocet adderall modafinil phentermine clenbuterol anabolic steroids-online onlinepharmacy
online-pharmacy online-pharmacies canadian-pharmacy no-prescription without-prescription cheap-meds cheapmeds
diet-pills dietpills weight-loss-pills penis-enlargement
warez keygen keygens crackz serialz nulled nulled-scripts cracked-software torrentz carding carders cvv-shop
fullz stolen-cards fake-id fake-ids fake-passports
payday-loan payday-loans paydayloan paydayloans get-rich-quick make-money-fast work-from-home-jobs
replica-watches replica-handbags replicawatches fake-rolex essay-mill buy-backlinks buy-followers buy-likes
""".split()

# Terms that ordinary urls hold too, one at a time. A line holds the forms of one term, its first word names them.
_SOFT_FORMS = """
spam spams spammer spammers
ads ad-click adserver adservers
popup popups popunder popunders
track tracker trackers
click clicks
promo promos promotion promotions
sponsored
affiliate affiliates
free freebie freebies
giveaway giveaways
win winner winners
prize prizes
reward
lucky
bonus bonuses
coupon coupons
voucher vouchers
discount discounts discounted
cheap cheaper cheapest
bargain bargains
sale
deals
offers
clearance
bet bets betting bettor bettors
wager wagers wagering
gamble gambles gambler
odds
poker
slot slots
bingo
lotto lottery lotteries
blackjack
baccarat
roulette
jackpot
stakes
tipster tipsters
raffle raffles
sweepstake sweepstakes
adult adults
sex sexy sexual
nude nudity
naked
erotic
escort escorts
fetish
lingerie
swinger swingers
webcam webcams cam cams
hot
babe babes
dating
singles
hookup
kinky
strip stripper strippers
mature
amateur amateurs
teen teens
pill pills
pharma pharmacy pharmacies
drug drugs drugstore drugstores
med meds medication medications
prescription prescriptions rx
tablets
capsules
steroid steroids
opioid opioids
painkiller painkillers
supplement supplements
slimming weightloss
detox
miracle
cure cures
loan loans lender lenders
payday
cash
credit
debt debts
mortgage mortgages
forex
binary
crypto bitcoin bitcoins
investment
profit profits
earn earnings income
rich millionaire
malware spyware adware
phishing phish
ransomware
keylogger keyloggers
botnet botnets
trojans
rootkit rootkits
farm
crack cracks cracked
hack hacks hacked hacker hackers
pirated piracy
torrent torrents
serials
replica replicas
counterfeit counterfeits
knockoff knockoffs
fake fakes
backlink backlinks
followers
traffic
seo
bulk
"""

_FORMS = {form: line.split()[0] for line in _SOFT_FORMS.strip().splitlines() for form in line.split()}

DEFAULT_VOCABULARY = Vocabulary(strict=tuple(_STRICT), soft=tuple(_FORMS), forms=tuple(_FORMS.items()))


def split_url(url):
    """Host and path columns of an url column, by the contract's wording."""
    rest = F.when(url.contains("://"), F.substr(url, F.instr(url, "://") + 3)).otherwise("")
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return ascii_lower(host), path


_ALNUM = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")
_LOWER = str.maketrans(UPPER, UPPER.lower())


class _Judge:
    def __init__(self, rules: dict[str, str], vocabulary: Vocabulary):
        self.rules: dict[str, list[tuple[str, str, str]]] = {}
        for rule, verdict in rules.items():
            host, _, path = rule.partition("/")
            self.rules.setdefault(host, []).append(("/" + path, rule, verdict))
        self.limit = vocabulary.soft_limit
        self.automaton = ahocorasick.Automaton()
        for name, terms in vocabulary.terms_by_name().items():
            for term in terms:
                self.automaton.add_word(term, (term, name, False))
        for term in vocabulary.strict:
            self.automaton.add_word(term, (term, term, True))
        self.automaton.make_automaton()

    def rule(self, host: str, path: str) -> tuple[str | None, str | None]:
        best, verdict = None, None
        at = 0
        while host and at >= 0:
            for prefix, rule, says in self.rules.get(host[at:], ()):
                if path.startswith(prefix) and (best is None or (len(rule), rule) > (len(best), best)):
                    best, verdict = rule, says
            dot = host.find(".", at)
            at = dot + 1 if dot >= 0 else -1
        return best, verdict

    def hits(self, text: str) -> tuple[int, int]:
        """Distinct strict terms and names of soft terms that stand alone in ``text``."""
        strict, soft = set(), set()
        if self.automaton.kind != ahocorasick.AHOCORASICK:
            return 0, 0
        for end, (term, name, is_strict) in self.automaton.iter(text):
            begin = end - len(term) + 1
            before = text[begin - 1] if begin else "/"
            after = text[end + 1] if end + 1 < len(text) else "/"
            if before not in _ALNUM and after not in _ALNUM:
                (strict if is_strict else soft).add(name)
        return len(strict), len(soft)


def judge_urls(
    pages: DataFrame,
    rules: dict[str, str] | None = None,
    vocabulary: Vocabulary = DEFAULT_VOCABULARY,
    page_id: str = "page_id",
    url: str = "url",
) -> DataFrame:
    """``page_id, host, path, rule, verdict, strict_hits, soft_hits`` of every row."""
    rules = CONTRACT_RULES if rules is None else rules
    urls = pages.select(F.col(page_id).cast("long").alias("page_id"), F.coalesce(F.col(url), F.lit("")).alias("url"))
    host, path = split_url(F.col("url"))
    parts = urls.select("page_id", host.alias("host"), path.alias("path"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = _Judge(rules, vocabulary)
        for batch in batches:
            out = []
            for host, path in zip(batch.column("host").to_pylist(), batch.column("path").to_pylist()):
                rule, verdict = judge.rule(host, path)
                strict, soft = judge.hits((host + path).translate(_LOWER))
                if verdict is None:
                    verdict = "block" if strict or soft >= judge.limit else "allow"
                out.append((rule, verdict, strict, soft))
            columns = list(zip(*out)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(n) for n in ("page_id", "host", "path")),
                    pa.array(columns[0], pa.string()),
                    pa.array(columns[1], pa.string()),
                    pa.array(columns[2], pa.int32()),
                    pa.array(columns[3], pa.int32()),
                ],
                names=["page_id", "host", "path", "rule", "verdict", "strict_hits", "soft_hits"],
            )

    return parts.mapInArrow(
        run, "page_id long, host string, path string, rule string, verdict string, strict_hits int, soft_hits int"
    )
