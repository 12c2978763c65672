"""The labelled table that the personal-data model is trained from.

One line of text per entry. ``<kind:words>`` marks personal data; everything else is none. Digits
are examples of their shape only: the model never sees which digit stands where.
"""

EXAMPLES = """
write to <email:anna.berg@mail3.example.com> for details
Contact: <email:j_smith+news@example.org>, please
the.<email:the.92@mail2.example.com> and others
mail <email:ann@localhost> on the old host
<email:support@shop.example>
e-mail <email:o'neil@example.ie> or call
Reply to <email:jörg@example.de> soon
send it to (<email:team@example.com>) today
from <email:first.last@uni-ulm.example> with thanks
call <phone:+1 (743) 555-3824> now
phone <phone:(743) 555-3824> during the day
Tel. <phone:(521) 555-6210> or visit
tel <phone:521-555-6210> ask for Ann
mobile <phone:521.555.6210> any time
my number is <phone:521-555-6210> thanks
fax <phone:(030) 5551234> Berlin
Telefon <phone:030 5551234> täglich
phone: <phone:0301 555123> weekdays
call <phone:1-800-555-0199> free of charge
tél <phone:01 55 51 23 45> le matin
teléfono <phone:915 551 234> por favor
reach us at <phone:+44 20 7946 0958> or online
<phone:+49 (30) 901820-0> is the office
number <phone:(663) 555-6869> was listed
call <phone:555-0134> after six
dial <phone:00 44 20 7946 0958> from abroad
mobile <phone:0171 5551234> or write
card <card:4785 3805 9239 1139> was charged
Visa <card:4785380592391139> expires soon
paid with <card:4785-3805-9239-1139> yesterday
and <card:4994226020900891> the rest
<card:4465758382889437> <card:4465758382889437> twice
mastercard <card:5500 0000 0000 0004> on file
amex <card:3782 822463 10005> valid
amex <card:378282246310005> valid
card number <card:6011 1111 1111 1117> please
credit card: <card:3056 930902 5904>.
host <ip:152.143.123.131> replied
from <ip:8.196.197.208> to <ip:10.0.0.1> today
ip <ip:227.5.221.1>: timed out
server at <ip:192.168.1.254:8080> is up
address <ip:fe80::1ff:fe23:4567:890a> was logged
ip <ip:2001:db8:85a3::8a2e:370:7334> seen
client <ip:70.23.22.57>, port 443
token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" in the file
token = "1eb9c654e721b4f812088970e66a6345cee33dd6" here
key sk-4f9a8b7c6d5e4f3a2b1c is secret
commit 1f3870be274f6c49b3e31a0c6728957f was reverted
sha 9f86d081884c7d659a2feaa0c55ad015a3bf4f1b
in 1999 and 2024 we met
on 2024-01-15 at 12:30 sharp
the 12.05.2023 meeting and 3/4/2021 notes
about 3.14 or 2.718 in total
version 1.2.3 and v2.0.1 were released
release 10.4.2-beta of build 20240115
Licensed under the Apache License, Version 2.0.
Licensed under CC BY-NC 4.0.
GNU General Public License, version 3.
costs $19.99 or 20 EUR, 50% less
1,234,567 people in 100,000 homes
sum 12345 and 678901 items
order 4711 and invoice 2023-0815
invoice number 20230815 is due
section 3.2.1 of chapter 4
pages 12-15 and 100-110 of volume 7
ISBN 978-3-16-148410-0 in print
ISBN 9783161484100 in print
doi 10.1000/xyz123 is cited
room A4 on floor 2B with H2O
ISO 9001 and RFC 2822 apply
follow @anna and @team42 there
2@ 5 each
score 3:2 after 90 minutes
x1 x2 x3 = 5
| 12 | 34 | 56 | 78 |
12 34 56 78 90 11 12
1 2 3 4 5 6 7 8 9 10
100 200 300 400 500
5551234 units were sold
population 8443000 by 2010
id 123456789012 in table 3
serial 0000123400005678 scanned
tracking 1Z999AA10123456784 shipped
at 10:00:00 and 23:59:59 UTC
lat 52.5200 lon 13.4050
zip 10115 and 90210-1234
model X-200-300-4000 in stock
the 1990s and the 21st century
7th of May, 2nd edition
ratio 16:9 or 4:3
5-3 and 2-1 wins
"""
