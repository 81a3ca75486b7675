"""The small labelled table that the field for personal data is trained from by default.

Lines written by hand, then lines drawn by rule: pseudo-words, a cue (or a pseudo-word in its
place), a value in one of many forms, and as many lines whose digits and dots are nothing personal.
"""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

from skyframe.llm.pii import luhn

#: One text a line; a mark holds the kind and what belongs to it.
MARKED = """
Please write to [[email|anna.meyer@example.org]] before Friday.
Contact: [[email|j_doe+news@mail.example.co.uk]], or call us.
The address is [[email|info@example.com]].
Mail [[email|sales-team@shop.example.net]] for a quote.
You can mail me: [[email|maria dot lopez at example dot org]] thanks.
Reach her by email [[email|k.tanaka at example dot com]] or not at all.
Send it to [[email|support at example dot net]] today.
My email is [[email|peter at mail dot example dot com]], write any time.
Use [[email|jane (at) example (dot) org]] for questions.
Write [[email|tom [at] example [dot] net]] please.
Her mail was [[email|lee.w @ example.com]] in those days.
Ask [[email|frank at corp dot example dot com]], he knows.
It goes to [[email|nina dot berg at mail dot example dot net]] and no one else.
Questions? [[email|help at example dot org]]
Then [[email|omar at uni dot example dot edu]] wrote back.
Or mail [[email|li at example dot com]] for a copy.
She uses [[email|r dot ortiz at example dot com]] since May.
Drop a line to [[email|desk at news dot example dot com]] please.
The list is run by [[email|admin (at) lists (dot) example (dot) org]].
Write to [[email|editor [at] example [dot] com]] about it.
Old address: [[email|hans @ example.de]].
Both [[email|first.last@example.com]] and [[email|other_one@mail7.example.com]] bounced.
Comments to [[email|ruth (at) example.org]] please.
The list owner, [[email|d.novak [at] lists.example.net]], will answer.
Ask [[email|karin at example.com]] for the form.
Write to [[email|press at news.example.org]] for more.
Mail [[email|v.rossi at example.co.uk]] about the room.
My address is [[email|ivan {at} example.net]] now.
It came from [[email|lucy (at) math.example.edu]] last week.
Her desk ([[email|desk[at]example.org]]) is closed.
The author ([[email|h.lind(at)uni.example.se]]) adds a note.
E-mail: [[email|mary-ann at mail.example.com]]
Contact [[email|post at example.de]] or call.
Contact: [[email|shop at example.net]]
Email [[email|noah_k [at] example.org]], thanks.
Send it to [[email|anders.berg at example.com]] by Monday.
You can reach [[email|helen at dept.example.edu]] all day.
Please mail tina at corp.example.com soon.
Then mail rob at example.org, he has it.
She stays at example.com until June.
He worked at example.net before that.
Read more at example.com and tell us.
Visit our site at www.example.net for news.
See you at www.example.org soon.
Find us at example.org or in town.
Contact us at www.example.com for help.
Write to us at example.net if you like.
Email us at www.mail.example.org today.
The book is sold at shop.example.com for less.
It is hosted at code.example.org by a friend.
The pages are kept at example.edu since then.
He works at example.com as a clerk.
Photos are online at photos.example.net.
The class is found at org.example.tools in the tree.
Look at example.com, then at example.org.
Learn more about it at blog.example.org.
More information at www.example.co.uk.
They stayed at home.Then it rained.
She teaches at St.Martin in town.
Stop at e.g. the next house.
The talk is at noon at U.S.C. this year.
Sign up at example.com/join to get the paper.
The report (at last) is on example.org now.
The full text is available at data.example.gov.
Tickets at tickets.example.com or at the door.
Follow the story at news.example.com tonight.
We met at the dot on the map at noon.
He looked at the dot and at the line.
Stay at home and look at the sky.
Look at the red dot in the middle.
The dot product of two vectors is a number.
She arrived at 10 and left at 12.
At 5 we meet at the dot com office.
Call [[phone|+1 (212) 555-0147]] now.
Phone [[phone|+49 30 5550 1234]] for help.
Tel. [[phone|+44 20 7946 0958]], ask for Sam.
Her number is [[phone|(212) 555-0147]] at work.
Call me at [[phone|212-555-0199]] tonight.
Mobile [[phone|0171 555 0123]] or mail.
Fax: [[phone|(030) 555-01234]].
Telephone [[phone|030 5550 12345]] from nine to five.
Phone: [[phone|555.867.5309]] in the morning.
You reach us by phone [[phone|1-800-555-0100]] free of charge.
Please call [[phone|(415) 555 0162]] and ask.
Ring [[phone|(617) 555-0134]] or write.
Call [[phone|(312) 555-0177]] or [[phone|312 555 0188]] soon.
Her phone is [[phone|0301 5557 0182]], his is not known.
Number: [[phone|040 5551 2345]].
Dial [[phone|415-555-0111]] and wait.
Reception: [[phone|+33 1 55 50 12 34]].
Reached at [[phone|+1 (974) 555-3436]] that day.
Text [[phone|917.555.0121]] for a table.
The server at [[ip|192.168.10.24]] does not answer.
Ping [[ip|10.0.0.1]] from the host.
Requests came from [[ip|203.0.113.77]], then stopped.
IP address: [[ip|198.51.100.3]].
Host [[ip|172 . 16 . 0 . 9]] is down.
Blocked [[ip|8.8.4.4]] and [[ip|8.8.8.8]] last night.
Version 2.4.1 came after version 2.4.
Section 3.2.1 and section 4.1 are new.
See section 12.4.3.2.1 of the manual.
Licensed under CC BY-NC 4.0.
Under the Apache License, Version 2.0.
From [[ip|97.51.17.173]] came the same words.
Both [[ip|129.38.82.176]] and [[ip|170.106.47.218]] are in use.
Gateway [[ip|10 . 20 . 30 . 1]] and nothing more.
Card number [[card|4111 1111 1111 1111]] expires soon.
Paid by visa [[card|4012888888881881]] on Monday.
Credit card: [[card|5555-5555-5555-4444]].
The card [[card|378282246310005]] was declined.
My card no [[card|6011 0009 9013 9424]], thanks.
Charged to [[card|4222 2222 2222 2]] last week.
Use card [[card|3714-496353-98431]] this time.
It was [[card|6011111111111117]] on the form.
Order 9807915762804490 was sent.
The total of 2849012375538201 rows was counted.
In 1998 and 2004 the price was 250.
Between 1914-1918 and 1939-1945 nothing was built.
It cost 1,250.00 in the year 2001.
The years 2010 2011 2012 2013 2014 were dry.
Table 4: 12 15 18 21 24 27 30.
Scores were 100-98, 87-85 and 77-70.
Lines 100 to 250 of part 3.
token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"
The id a81f9c20 and 77b0e1d4 are hex.
The ratio is 3.14159 to 1.
ISBN 978 3 16 148410 0 is a book number.
Room 12, floor 3, building 7.
On 2021-03-14 at 15:09:26 it began.
Dates such as 24.12.2020 and 01.01.2021 are days off.
It weighs 70 kg and is 180 cm tall.
""".strip().split("\n")


#: What stands before and after what is marked, by kind.
BEFORE = {
    "email": "write to|contact|mail|email:|e-mail:|reach me at|send it to|my address is|ask|address:|or mail|questions to|the author,".split("|"),
    "phone": "call|phone|phone:|tel.|tel:|telephone:|mobile:|cell|fax|dial|ring|text|number:|my number is|reach us at|contact:|office:|call us on".split("|"),
    "ip": "server|the server at|host|ip|ip:|ip address|address|ping|from|gateway|blocked|login from|requests from|connect to|client".split("|"),
    "card": "card|card:|card number|credit card|visa|mastercard|amex|paid with|charged to|debit card:|my card is|card no.|payment by".split("|"),
}
AFTER = "|.|,|, please|for help|today|at any time|and ask| (work)|, thanks|or not at all|soon|in the morning|;|, then wait|was given|)".split("|")
#: Lines without personal data; # is a digit, @ a pseudo-word.
CLEAN = """
on ####-##-## at ##:##:## it began
order ################ was sent to @
order no. ######## of ## items
the total of ############## rows
isbn ### # ## ###### # is a book
isbn ###-#-##-######-#
issn ####-#### in print
version #.#.# came after #.##
section #.#.# and section #.##.#
release #.##.#.#### of the tool
see section ##.#.#.#.# of the manual
it cost #,###.## in the year ####
$ ##.## or ## %
between ####-#### and ####-####
the years #### #### #### ####
table #: ## ## ## ## ## ##
scores were ###-##, ##-## and ##-##
lines ### to ### of part #
the ratio is #.##### to #
room ##, floor #, building #
dates such as ##.##.#### and ##/##/####
it weighs ## kg and is ### cm tall
population of ###,### or # ### ###
at ##.####, -##.#### on the map
the id @##@# and #@##@## are hex
chapter #, pages ###-###
zip #####-####
part ##-####-## of the set
from ####-##-##T##:##:## on
ratio ## : ## : ##
line #### col ## in @
timeout after ###### ms, code ####
( # ) first, ( # ) second
# . # . # of the list
row ### ### ### of #### #### ####
figure #.#(#) and eq. (##.#)
#### @ street, @ #####
account of ###.###.### units
she stays at @.com until june
see @ at @.org for more
read the @ at www.@.com
the @ at www.@.co.uk was @
a @ at @.@.org tells of it
the @ is at @.@.@ in the @
it is at @.@.com and was at @.org
the files are at @.@ on the @
kept at @.@.net by the @
found at @.@.@ in the list
@ was sold at @.com for less
find @ at www.@.com or in town
join @ at @.net this week
the @ at @.@.edu is open
read more at @.org/@ and tell us
visit us at www.@.net for news
the talk is at noon in room ###
look at the dot on the map
at the dot of ## we met
they stayed at home.then it rained
he works at @.com as a clerk
more at @.@.edu for all
the dot product of @ and @
@ (at ## @) and @ (at ## @)
""".strip().split("\n")


def _word(draw: random.Random) -> str:
    return "".join(draw.choice("b c d f g h k l m n p r s t v w br st ch tr".split()) + draw.choice("a e i o u ai ee".split()) for _ in range(draw.randint(1, 3))) + draw.choice(["", "", "n", "s", "r"])


def _digits(pattern: str, draw: random.Random) -> str:
    return "".join(draw.choice("123456789" if i and pattern[i - 1] in "(" or not i else "0123456789") if c == "#" else c for i, c in enumerate(pattern))


#: How a number is written; # is a digit.
PHONES = "(###) ###-####|(###) ### ####|(###)###-####|###-###-####|###.###.####|### ### ####|0### ### ####|0### #######|0## #### ####|0## ########|(0##) #### ####|(0##) ####-####|0###/######|0### / ## ## ##|1-800-###-####|1 ### ### ####|1 (###) ###-####|00## ## #### ####|00## ### ######|+# ### ### ####|+## ## #### ####|+## (0) ### ######|0# ## ## ## ##|0#-####-####".split("|")
CARDS = "#### #### #### ####|####-####-####-####|################|#### ###### #####|####-######-#####|###############|####.####.####.####|#### - #### - #### - ####|####  ####  ####  ####|#### #### #### #".split("|")


def value_of(kind: str, draw: random.Random) -> str:
    """One written value of a kind, most of them in forms that the fixed patterns do not know."""
    if kind == "phone":
        return _digits(draw.choice(PHONES), draw)
    if kind == "card":
        while True:
            text = _digits(draw.choice(CARDS), draw)
            if luhn("".join(c for c in text if c.isdigit())):
                return text
    if kind == "ip":
        joint = draw.choice([".", ".", " . ", "[.]", " dot ", "(.)", " [.] "])
        return joint.join(str(draw.choice([draw.randint(0, 255), draw.randint(1, 9), 10, 192])) for _ in range(4))
    spelled = draw.random() < 0.5
    at = draw.choice([" at ", " (at) ", " [at] ", "(at)", "[at]", " {at} ", " AT "] + ([] if spelled else [" @ ", "@"]))
    dot = draw.choice([" dot ", " dot ", " (dot) ", " [dot] ", "[dot]", " DOT "]) if spelled else "."
    if spelled and draw.random() < 0.2:
        at = draw.choice(["@", " @ "])
    local = _word(draw)
    if draw.random() < 0.5:
        local += (draw.choice([dot, ".", "_", "-"]) if spelled else draw.choice("._-+")) + _word(draw)
    if draw.random() < 0.15:
        local += str(draw.randint(1, 99))
    host = [_word(draw) for _ in range(draw.choice([1, 1, 1, 2]))]
    return local + at + dot.join([*host, draw.choice("com org net edu de fr co.uk io".split()).replace(".", dot)])


def varied(n: int, seed: int = 7, before: dict[str, list[str]] = BEFORE, after: list[str] = AFTER, clean: list[str] = CLEAN) -> list[str]:
    """``n`` marked lines drawn by rule: kinds in turn, and as many clean lines as marked ones."""
    draw = random.Random(seed)
    kinds = list(BEFORE)
    out = []
    for i in range(n):
        lead = " ".join(_word(draw) for _ in range(draw.randint(0, 4)))
        tail = " ".join(_word(draw) for _ in range(draw.randint(0, 3)))
        if i % 2:
            body = "".join(_word(draw) if c == "@" else c for c in _digits(draw.choice(clean), draw))
        else:
            kind = kinds[i // 2 % len(kinds)]
            end = draw.choice(after) if draw.random() < 0.7 else draw.choice(["? ", "! ", " ", " - "]) + _word(draw)
            # Now and then a word that says nothing, so that the field does not live on cues alone.
            cue = draw.choice(before[kind]) if draw.random() < 0.5 else _word(draw)
            body = f"{cue} [[{kind}|{value_of(kind, draw)}]]{' ' * end[:1].isalpha()}{end.rstrip()}"
            if draw.random() < 0.25:
                body += f"{draw.choice([' or', ' and', ', or', ';', ','])} [[{kind}|{value_of(kind, draw)}]]"
        if draw.random() < 0.5:
            body = body[0].upper() + body[1:]
        out.append(" ".join(filter(None, [lead, body, tail])))
    return out


#: Lines drawn by rule beside those written by hand.
DRAWN = 1600


def default_labelled(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(line,) for line in [*MARKED, *varied(DRAWN)]], "marked string")
