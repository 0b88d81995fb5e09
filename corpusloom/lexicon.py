"""Word lists used by the text functions."""

# The default stop words.
STOP_WORDS = tuple(
    """
    a about above after again against all am an and any are aren't as at be because been before
    being below between both but by can't cannot could couldn't did didn't do does doesn't doing
    don't down during each few for from further had hadn't has hasn't have haven't having he he'd
    he'll he's her here here's hers herself him himself his how how's i i'd i'll i'm i've if in into
    is isn't it it's its itself let's me more most mustn't my myself no nor not of off on once only
    or other ought our ours ourselves out over own same shan't she she'd she'll she's should
    shouldn't so some such than that that's the their theirs them themselves then there there's
    these they they'd they'll they're they've this those through to too under until up very was
    wasn't we we'd we'll we're we've were weren't what what's when when's where where's which while
    who who's whom why why's with won't would wouldn't you you'd you'll you're you've your yours
    yourself yourselves
    """.split()
)

# Words the usual English word tokeniser cuts in two.
FUSED_FORMS = (("can", "not"), ("gim", "me"), ("gon", "na"), ("got", "ta"), ("lem", "me"), ("wan", "na"))

# A small irregular-form table: token, part of speech, lemma.
LEMMAS = tuple(
    tuple(line.split())
    for line in """
    was v be
    were v be
    is v be
    are v be
    been v be
    am v be
    has v have
    had v have
    does v do
    did v do
    done v do
    said v say
    says v say
    went v go
    goes v go
    gone v go
    made v make
    took v take
    taken v take
    came v come
    got v get
    gave v give
    given v give
    found v find
    thought v think
    told v tell
    became v become
    left v leave
    felt v feel
    brought v bring
    began v begin
    begun v begin
    kept v keep
    held v hold
    wrote v write
    written v write
    stood v stand
    heard v hear
    meant v mean
    met v meet
    paid v pay
    sat v sit
    spoke v speak
    spoken v speak
    led v lead
    lost v lose
    built v build
    sent v send
    spent v spend
    won v win
    bought v buy
    sold v sell
    fell v fall
    fallen v fall
    ran v run
    running v run
    rose v rise
    risen v rise
    grew v grow
    grown v grow
    knew v know
    known v know
    saw v see
    seen v see
    men n man
    women n woman
    children n child
    feet n foot
    teeth n tooth
    mice n mouse
    geese n goose
    lives n life
    wives n wife
    knives n knife
    leaves n leaf
    shelves n shelf
    wolves n wolf
    halves n half
    thieves n thief
    players n player
    matches n match
    corporations n corporation
    governments n government
    ministers n minister
    companies n company
    countries n country
    markets n market
    games n game
    """.strip().splitlines()
)

# Suffix rules of the public English dictionary lemmatiser, as part of
# speech, ending, replacement.
SUFFIX_RULES = (
    ("n", "s", ""), ("n", "ses", "s"), ("n", "ves", "f"), ("n", "xes", "x"), ("n", "zes", "z"),
    ("n", "ches", "ch"), ("n", "shes", "sh"), ("n", "men", "man"), ("n", "ies", "y"),
    ("v", "s", ""), ("v", "ies", "y"), ("v", "es", "e"), ("v", "es", ""), ("v", "ed", "e"),
    ("v", "ed", ""), ("v", "ing", "e"), ("v", "ing", ""),
)
