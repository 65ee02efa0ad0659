"""A small labelled table of text blocks, from which the tree that tells main text from the rest of a page is trained.

One line a block, pages apart by an empty line: whether it is main text, where it stands (``inside`` a marked article, ``outside`` of the
page's one, in a ``plain`` page without such marks, or in ``furniture``: menus, notices and the like by their tags or names),
whether it is a heading, its words, and how many of them are links.
"""

BLOCKS = """
0 furniture - 1 1
0 furniture - 2 2
0 furniture - 9 0
1 inside heading 8 0
1 inside - 64 0
1 inside - 3 0
1 inside - 1 0
1 inside - 12 12
1 inside - 140 6
0 furniture - 11 2

0 outside heading 3 0
0 outside - 22 0
0 outside - 2 2
1 inside heading 2 0
1 inside - 7 0
1 inside - 7 7
1 inside - 33 1
1 inside heading 4 4
1 inside - 55 20
0 furniture - 48 0
0 furniture heading 2 0
0 furniture - 95 3
0 outside - 30 4
0 outside - 60 0

0 outside - 1 1
0 outside - 85 2
1 inside - 1 1
1 inside - 250 0
1 inside - 2 0
0 furniture heading 5 0
0 furniture - 160 1
0 furniture - 3 3
0 outside heading 6 6

0 furniture heading 9 0
0 furniture - 40 0
0 furniture - 4 0
1 plain heading 7 0
1 plain - 71 2
1 plain - 38 0
0 furniture - 25 0
1 plain - 44 1
0 furniture - 17 17

0 plain - 1 1
0 plain - 2 2
0 plain - 1 1
0 plain - 3 3
1 plain heading 9 0
1 plain - 58 0
1 plain - 16 0
1 plain - 96 5
1 plain heading 3 0
1 plain - 41 0
1 plain - 9 0
1 plain - 77 2
0 plain - 4 4
0 plain - 6 6
0 plain - 5 5
0 plain - 8 1

0 plain - 5 5
0 plain - 4 4
0 plain - 6 0
1 plain heading 11 0
1 plain - 29 0
1 plain - 112 3
1 plain - 20 1
1 plain - 66 0
0 plain heading 2 0
0 plain - 7 7
0 plain - 9 9
0 plain - 6 6
0 plain - 12 3

0 plain - 14 14
0 plain - 3 0
0 plain - 2 2
1 plain heading 6 0
1 plain - 24 0
1 plain - 6 0
1 plain - 51 0
1 plain - 130 9
1 plain - 12 0
1 plain - 35 0
0 plain - 3 2
0 plain - 10 0
0 plain - 7 3

0 plain - 2 2
0 plain - 2 2
0 plain - 7 0
0 plain - 2 2
1 plain heading 5 0
1 plain - 47 1
1 plain - 18 0
1 plain heading 2 0
1 plain - 88 0
0 plain - 3 3
0 plain - 26 22
0 plain - 19 15
0 plain - 4 0

0 furniture - 30 0
1 inside heading 1 0
1 inside - 2 0
1 inside - 180 0
1 inside - 1 0
1 inside - 95 0
1 inside - 2 2
1 inside - 1 1
1 inside - 5 2
1 inside - 2 0
0 furniture - 15 0

0 furniture - 7 7
1 inside heading 5 5
1 inside - 66 60
1 inside - 67 0
1 inside - 1 0
1 inside - 68 2
1 inside - 2 0
1 inside - 20 20
1 inside - 3 3
1 inside - 4 4
1 inside - 8 8
1 inside - 6 6
1 inside - 2 2
1 inside - 120 0
1 inside - 2 0
1 inside - 70 35
1 inside - 4 0
0 outside - 40 0

1 inside - 9 9
1 inside - 15 14
1 inside - 72 0
1 inside - 1 0
1 inside - 400 2
1 inside - 3 0
1 inside - 11 6
1 inside - 1 1
0 furniture - 70 0

1 plain - 61 0
1 plain - 45 0

1 plain heading 4 0
1 plain - 23 0

0 plain - 3 3
0 plain - 5 0
0 plain - 2 1
"""
