import sys

from quarry.cli import main

main(sys.argv[1:])
