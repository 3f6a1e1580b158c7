"""Stop words."""

# Common English function words of two or more letters.
ENGLISH = tuple(
    """
    about above after again against all also although always am among an and another any are around as at
    be because been before being below between both but by can cannot could did do does doing done down during
    each either else ever every few first for from further had has have having he hence her here hers herself
    him himself his how however if in indeed into is it its itself just last least less made many may me might
    more most much must my myself neither never no nor not nothing now of off often on once one only onto or
    other others our ours ourselves out over own per perhaps please rather same she should since so some still
    such than that the their theirs them themselves then there therefore these they this those through thus to
    together too toward two under until up upon us very was we well were what when where whether which while
    who whole whom whose why will with within without would yet you your yours yourself yourselves
    """.split()
)
