import sys

from contentmart.cli import main

main(sys.argv[1:])
