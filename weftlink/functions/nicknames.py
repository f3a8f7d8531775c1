"""Short and pet forms of given names, and what else stands in a name field without being a name."""

from __future__ import annotations

#: Formal given name and its usual short forms.
SHORT_FORMS = {
    "abigail": "abby abbie gail",
    "alexander": "alex sandy xander sasha",
    "archibald": "archie baldie",
    "benjamin": "ben benny benji",
    "bernadette": "bernie detta",
    "catherine": "cathy cat kate katie",
    "charles": "charlie chuck chas",
    "christopher": "chris kit topher",
    "concepcion": "concha conchita",
    "daniel": "dan danny",
    "david": "dave davy",
    "dorothy": "dot dottie dolly",
    "edward": "ed eddie ned ted",
    "elizabeth": "beth betty eliza liz lizzie libby",
    "francisco": "paco pancho",
    "frederick": "fred freddie fritz",
    "gabriella": "gaby ella gabby",
    "guadalupe": "lupe lupita",
    "ignacio": "nacho",
    "james": "jim jimmy jamie",
    "john": "jack johnny",
    "jonathan": "jon jonny",
    "joseph": "joe joey",
    "josephine": "jo josie",
    "katherine": "kate kathy katie kitty kit",
    "leonard": "len lenny leo",
    "margaret": "maggie meg peggy greta",
    "matthew": "matt",
    "matthias": "matt hias",
    "michael": "mike mick",
    "nicholas": "nick nico",
    "patricia": "pat patty trish tricia",
    "penelope": "penny nell",
    "rebecca": "becca becky",
    "richard": "dick rich rick ricky",
    "robert": "bob bobby rob robbie",
    "samantha": "sam sammie",
    "samuel": "sam sammy",
    "susannah": "sue susie sanna",
    "theodore": "ted theo teddy",
    "thomas": "tom tommy",
    "valentina": "val tina",
    "victoria": "vicky tori vic",
    "wilhelmina": "mina willa minnie",
    "william": "will bill billy liam willie",
    "zachary": "zach zack",
}
#: Words that fill a name field without naming anybody.
NO_NAME = ("unknown", "unk", "test", "testing", "doe", "baby", "girl", "boy", "none", "na", "null", "nobody", "anonymous", "patient", "xx", "xxx")
#: Forms of address, generational suffixes and particles.
TITLES = ("mr", "mrs", "ms", "miss", "dr", "prof", "sir")
SUFFIXES = ("jr", "sr", "ii", "iii", "iv")
PARTICLES = ("de", "la", "del", "los", "las", "von", "van", "der", "den", "di", "da", "du", "le", "mac", "mc", "of", "y")


def formal_forms() -> dict[str, frozenset[str]]:
    """Each short form and formal name with all formal names it can stand for."""
    out: dict[str, set[str]] = {name: {name} for name in SHORT_FORMS}
    for name, short in SHORT_FORMS.items():
        for s in short.split():
            out.setdefault(s, set()).add(name)
    return {k: frozenset(v) for k, v in out.items()}
